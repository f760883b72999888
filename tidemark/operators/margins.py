"""Preference margins: events from regulation sheets, intervals, margins in force."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import percent, trimmed
from ..scratch import small
from .changes import surrogate_ids
from .dedup import keep_top_value
from .history import event_intervals, latest_active

# Fixed values of events.
OPENS, CLOSES = "habilita", "desabilita"
CONTENT, TECHNOLOGY = "conteudo_nacional", "tecnologia_nacional"
#: Regulations in force up to this many are broadcast.
REGULATIONS = 10_000


def sheet_events(rows: DataFrame, content_needs_margin: bool, regulation: str = "resolucao") -> DataFrame:
    """Opening events of sheet rows (all text) with a code: one for national content, one for national
    technology where the additional margin is filled. With content_needs_margin, content events need a filled
    normal margin. One pass: each row explodes into its events."""
    filled = lambda c: F.coalesce(trimmed(c) != "", F.lit(False))
    shared = [trimmed("regra_de_origem").alias("margem_normal_comprovante"), percent("margem_normal").alias("margem_normal_pct")]
    none = [F.lit(None).cast("string").alias("margem_adicional_comprovante"), F.lit(None).cast("double").alias("margem_adicional_pct")]
    extra = [F.replace(trimmed("regra_de_qualificacao"), F.lit(" "), F.lit("_")).alias("margem_adicional_comprovante"), percent("margem_adicional").alias("margem_adicional_pct")]
    content = F.struct(F.lit(CONTENT).alias("tipo_margem"), *shared, *none)
    technology = F.struct(F.lit(TECHNOLOGY).alias("tipo_margem"), *shared, *extra)
    events = F.array_compact(F.array(F.when(filled("margem_normal") if content_needs_margin else F.lit(True), content), F.when(filled("margem_adicional"), technology)))
    out = rows.where(filled("ncm")).select(trimmed(regulation).alias("resolucao"), F.lit(OPENS).alias("tipo_evento_margem"), trimmed("ncm").alias("prefixo_ncm"), F.explode(events).alias("e"), trimmed("grupo_de_produtos").alias("grupo_de_produtos"), trimmed("comentario").alias("comentario"))
    return out.select("resolucao", "tipo_evento_margem", "e.tipo_margem", "prefixo_ncm", "e.margem_normal_comprovante", "e.margem_normal_pct", "e.margem_adicional_comprovante", "e.margem_adicional_pct", "grupo_de_produtos", "comentario")


def succession_events(rows: DataFrame, order: list[str]) -> DataFrame:
    """Events of regulations that replace each other in order: each opens its rows and closes all rows of
    the one before, under its own name."""
    opened = sheet_events(rows.where(trimmed("resolucao").isin(*order)), content_needs_margin=False)
    after = dict(zip(order, order[1:], strict=False))
    if not after:
        return opened
    following = F.create_map(*(F.lit(x) for pair in after.items() for x in pair))
    closed = opened.where(F.col("resolucao").isin(*after)).withColumn("resolucao", following[F.col("resolucao")]).withColumn("tipo_evento_margem", F.lit(CLOSES))
    return opened.unionByName(closed)


def dated(events: DataFrame, regulations: DataFrame) -> DataFrame:
    """Events with data_evento, the day their regulation (id, vigencia_inicio) takes effect."""
    days = regulations.select(F.col("id").alias("resolucao"), F.col("vigencia_inicio").cast("date").alias("data_evento"))
    return events.join(small(days, REGULATIONS), "resolucao")


def event_table(succession: DataFrame, standing: DataFrame, regulations: DataFrame) -> DataFrame:
    """All events, one of each code, day and kind (the largest margin), numbered by day, kind and code."""
    events = dated(succession.unionByName(standing), regulations).withColumn("margem_sustentabilidade_pct", F.lit(None).cast("decimal(3,2)"))
    best = keep_top_value(events, ["prefixo_ncm", "data_evento", "tipo_evento_margem"], ["margem_normal_pct", "margem_adicional_pct", "margem_sustentabilidade_pct"])
    return surrogate_ids(best, [F.col(c).asc_nulls_last() for c in ("data_evento", "tipo_evento_margem", "prefixo_ncm")], "id_evento_margem")


def margin_intervals(events: DataFrame, family: str = "cics") -> DataFrame:
    """Intervals of the events with ultima and ativa, one of each code and start (the largest margin)."""
    mine = F.startswith(F.col("resolucao"), F.lit(family))
    kept = events.drop("id_evento_margem").withColumn("_family", mine)
    intervals = event_intervals(kept, ["_family", "prefixo_ncm", "tipo_margem"], "data_evento", "tipo_evento_margem", OPENS)
    flagged = latest_active(intervals, ["_family", "prefixo_ncm"])
    best = keep_top_value(flagged, ["_family", "prefixo_ncm", "data_inicio"], ["margem_normal_pct", "margem_adicional_pct", "margem_sustentabilidade_pct"])
    return best.drop("_family")


def active_margins(intervals: DataFrame, prefixes: DataFrame, family: str) -> DataFrame:
    """Margins of a family in force, for every leaf code under their prefix."""
    live = intervals.where(F.startswith(F.col("resolucao"), F.lit(family)) & F.col("ativa"))
    leaves = prefixes.select(F.col("prefixo").alias("prefixo_ncm"), F.col("codigo").alias("ncm"), F.col("descricao").alias("ncm_descricao"))
    return live.join(leaves, "prefixo_ncm")
