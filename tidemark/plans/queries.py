"""Registered queries of the lakehouse operators, and the SQL that says the same.

Stand-in tables are derived by SQL that Spark and DuckDB both read, so each side starts from one text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import columns as C
from ..operators import changes, checks, dedup, hierarchy as H, history, margins, summaries, translator
from ..scratch import shared_path, shared_table, stored
from ..sources import scans, sinks
from . import jobs

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The stand-in that sql describes."""
    for name in TABLES:
        if name in sql:
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def query(name: str, oracle: str | None = None):
    def register(f):
        QUERIES[name] = f
        if oracle:
            ORACLE_SQL[name] = oracle
        return f

    return register


# ---- stand-ins -------------------------------------------------------------------------------------------
_ONE_PURCHASE = """SELECT o_custkey AS cod_compra, CAST(o_orderdate AS DATE) AS data_atualizacao,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS situacao, CASE WHEN o_orderkey % 2 <> 0 THEN o_orderstatus END AS situacao_pncp,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS prioridade,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(year(o_orderdate) AS INT) END AS ano_compra, CASE WHEN o_orderkey % 2 <> 0 THEN CAST(year(o_orderdate) AS INT) END AS ano_compra_pncp,
  CAST(o_totalprice AS DECIMAL(18,2)) AS valor FROM orders"""
PURCHASES = f"SELECT * FROM ({_ONE_PURCHASE}) a UNION ALL SELECT * FROM ({_ONE_PURCHASE}) b"
VARIANTS = ["situacao", "ano_compra"]
PLAIN = f"SELECT cod_compra, data_atualizacao, prioridade, valor, coalesce(situacao, situacao_pncp) AS situacao, coalesce(ano_compra, ano_compra_pncp) AS ano_compra FROM ({PURCHASES}) p"
BEST = f"""SELECT cod_compra, data_atualizacao, prioridade, valor, situacao, ano_compra FROM (SELECT *, row_number() OVER (PARTITION BY cod_compra, data_atualizacao
  ORDER BY (CASE WHEN prioridade IS NULL THEN 0 ELSE 1 END) + (CASE WHEN valor IS NULL THEN 0 ELSE 1 END) + (CASE WHEN situacao IS NULL THEN 0 ELSE 1 END) + (CASE WHEN ano_compra IS NULL THEN 0 ELSE 1 END) DESC,
  prioridade ASC NULLS LAST, valor ASC NULLS LAST, situacao ASC NULLS LAST, ano_compra ASC NULLS LAST) AS rn FROM (SELECT DISTINCT * FROM ({PLAIN}) x) y) z WHERE rn = 1"""
HISTORY = f"""SELECT *, data_atualizacao AS valido_de, CAST(lead(data_atualizacao) OVER w - 1 AS DATE) AS valido_ate, lead(data_atualizacao) OVER w IS NULL AS is_current
  FROM ({BEST}) b WINDOW w AS (PARTITION BY cod_compra ORDER BY data_atualizacao ASC NULLS LAST)"""
_CODE = "lpad(CAST((p_partkey * 48271) % 100000000 AS STRING), 8, '0')"
CODES = f"SELECT {_CODE} AS c, p_name FROM part"
NODES = "SELECT codigo, min(p_name) AS descricao FROM (" + " UNION ALL ".join(f"SELECT left(c, {n}) AS codigo, p_name FROM ({CODES}) c{n}" for n in (2, 4, 5, 6, 7, 8)) + ") n GROUP BY codigo"
SHEETS = f"""SELECT 'cics_' || CAST(p_size % 4 AS STRING) AS resolucao, ' ' || left({_CODE}, 2) AS ncm, p_brand AS regra_de_origem,
  CASE WHEN p_size % 5 = 0 THEN '' WHEN p_size % 7 = 0 THEN '12,5' ELSE CAST(p_size AS STRING) END AS margem_normal, p_type AS regra_de_qualificacao,
  CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN ' ' ELSE CAST(p_size % 11 AS STRING) END AS margem_adicional, p_type AS grupo_de_produtos, p_name AS comentario FROM part"""
STANDING = SHEETS.replace("'cics_' || CAST(p_size % 4 AS STRING)", "'ciiapac_' || CAST(3 + p_size % 2 AS STRING)")
REGULATIONS = "SELECT 'cics_' || CAST(r_regionkey AS STRING) AS id, DATE '2024-01-01' + 30 * r_regionkey AS vigencia_inicio FROM region UNION ALL SELECT 'ciiapac_' || CAST(r_regionkey AS STRING) AS id, DATE '2024-01-01' + 30 * r_regionkey AS vigencia_inicio FROM region"
SUCCESSION = ["cics_0", "cics_1", "cics_2", "cics_3"]
SUGGESTIONS = f"""SELECT CASE WHEN p_partkey % 97 = 0 THEN ' ' ELSE ' ' || CAST(p_partkey AS STRING) END AS catmat, p_name AS catmat_descr, CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE left({_CODE}, CASE p_partkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 4 ELSE 8 END) END AS ncm,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE left({_CODE}, 2) END AS ncm_capitulo_sugerido_cod, left({_CODE}, 4) AS ncm_posicao_sugerida_cod, {_CODE} || ',' || {_CODE} AS ncm_subitem_sugerido_top_5_cod, p_name || '|' || p_type AS ncm_subitem_sugerido_top_5_descr FROM part"""
LOADS = "SELECT user_id AS codigo, date_trunc('day', ts) AS carga, event_type AS tipo FROM events"
MANIFEST = "SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'x' || h ELSE h END AS hash_sha256 FROM (SELECT page_id, {hash} AS h FROM pages) p WHERE page_id % 2 = 0"


# ---- projections, history, summaries ---------------------------------------------------------------------
@query("harmonize_variants", PLAIN)
def _(spark, d):
    return C.harmonize_variants(derive(spark, d, PURCHASES), VARIANTS)


@query("star_exclude", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(spark, d):
    return C.without(table(spark, d, "orders"), "o_totalprice", "o_orderdate", "o_orderpriority")


@query("audit_columns", "SELECT o_orderkey, o_orderstatus, TIMESTAMP '2024-05-01 00:00:00' AS _loaded_at, 'orders.parquet' AS _source_file FROM orders")
def _(spark, d):
    return C.audited(table(spark, d, "orders"), "2024-05-01 00:00:00").select("o_orderkey", "o_orderstatus", "_loaded_at", "_source_file")


@query("strict_cast", "SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INT) AS prioridade FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", C.strict_cast(F.left("o_orderpriority", F.lit(1)), "int").alias("prioridade"))


@query("completeness_score", f"SELECT cod_compra, data_atualizacao, CAST((CASE WHEN prioridade IS NULL THEN 0 ELSE 1 END) + (CASE WHEN situacao IS NULL THEN 0 ELSE 1 END) + (CASE WHEN valor IS NULL THEN 0 ELSE 1 END) + (CASE WHEN ano_compra IS NULL THEN 0 ELSE 1 END) AS INT) AS score FROM ({PURCHASES}) p")
def _(spark, d):
    df = derive(spark, d, PURCHASES)
    return df.select("cod_compra", "data_atualizacao", C.completeness(df.columns, ["cod_compra", "DATA_ATUALIZACAO"]).alias("score"))


@query("blank_filter", f"SELECT trim(catmat) AS catmat, nullif(trim(ncm), '-') AS ncm FROM ({SUGGESTIONS}) s WHERE trim(catmat) <> ''")
def _(spark, d):
    return C.not_blank(derive(spark, d, SUGGESTIONS), "catmat").select(C.trimmed("catmat").alias("catmat"), C.blank_to_null("ncm", "-").alias("ncm"))


@query("scalar_functions", f"SELECT c AS codigo, replace(c, '0', 'o') AS trocado, left(c, 4) AS posicao, CAST(length(c) AS INT) AS n, starts_with(c, '1') AS um, contains(c, '99') AS nove, regexp_extract(c, '^(..)', 1) AS capitulo, nullif(left(c, 1), '0') AS primeiro, round(try_cast(replace(c, '7', ',') AS DOUBLE) / 100, 4) AS pct, string_split(p_name, ' ')[1] AS palavra, sha256(c) AS hash FROM ({CODES}) x")
def _(spark, d):
    c = F.col("c")
    return derive(spark, d, CODES).select(
        c.alias("codigo"), F.replace(c, F.lit("0"), F.lit("o")).alias("trocado"), F.left(c, F.lit(4)).alias("posicao"), F.length(c).alias("n"), c.startswith("1").alias("um"), c.contains("99").alias("nove"),
        F.regexp_extract(c, "^(..)", 1).alias("capitulo"), F.nullif(F.left(c, F.lit(1)), F.lit("0")).alias("primeiro"), C.percent(F.replace(c, F.lit("7"), F.lit(","))).alias("pct"), F.get(F.split("p_name", " "), F.lit(0)).alias("palavra"), F.sha2(c, 256).alias("hash"),
    )


@query("level_names", f"SELECT codigo, CASE length(codigo) WHEN 2 THEN 'Capítulo' WHEN 4 THEN 'Posição' WHEN 5 THEN 'Subposição 1' WHEN 6 THEN 'Subposição 2' WHEN 7 THEN 'Item' WHEN 8 THEN 'Subitem' END AS nivel FROM ({NODES}) n")
def _(spark, d):
    return derive(spark, d, NODES).select("codigo", C.level_name(F.col("codigo")).alias("nivel"))


@query("dedup_exact", f"SELECT DISTINCT cod_compra, data_atualizacao, prioridade, valor, situacao, ano_compra FROM ({PLAIN}) p")
def _(spark, d):
    return dedup.dedup_exact(derive(spark, d, f"SELECT *, 'f' AS _source_file FROM ({PLAIN}) q"), ["_source_file"])


@query("dedup_most_complete", BEST)
def _(spark, d):
    df = dedup.dedup_exact(derive(spark, d, PLAIN))
    return dedup.keep_most_complete(df, ["cod_compra"], "data_atualizacao", exclude=["cod_compra", "data_atualizacao"])


@query("scd2_by_update", HISTORY)
def _(spark, d):
    return jobs.versioned(derive(spark, d, PURCHASES), ["cod_compra"], "data_atualizacao", VARIANTS)


@query("scd2_merged", HISTORY)
def _(spark, d):
    """The same history as a table that three loads are merged into: rows of a key come late, apart and again."""
    base, raw = shared_path(spark, "history"), derive(spark, d, PURCHASES)
    load = F.pmod(F.col("cod_compra") + F.dayofyear("data_atualizacao"), F.lit(3))
    for k in range(3):
        out = jobs.merge_versions(raw.where((load == k) | (F.col("cod_compra") % 50 == 0)), base, ["cod_compra"], "data_atualizacao", run=f"load-{k}", variants=VARIANTS, buckets=16)
    return out


@query("scd2_current", f"SELECT * EXCLUDE (is_current) FROM ({HISTORY}) h WHERE is_current")
def _(spark, d):
    return jobs.published(derive(spark, d, PURCHASES), ["cod_compra"], "data_atualizacao", variants=VARIANTS)


@query("scd2_items_history", """WITH r AS (SELECT DISTINCT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS dia, l_quantity, l_returnflag FROM lineitem),
  b AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey, dia ORDER BY l_quantity ASC NULLS LAST, l_returnflag ASC NULLS LAST) AS rn FROM r) x WHERE rn = 1)
  SELECT *, dia AS valido_de, CAST(lead(dia) OVER w - 1 AS DATE) AS valido_ate, lead(dia) OVER w IS NULL AS is_current FROM b WINDOW w AS (PARTITION BY l_partkey, l_suppkey ORDER BY dia ASC NULLS LAST)""")
def _(spark, d):
    raw = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", F.col("l_shipdate").alias("dia"), "l_quantity", "l_returnflag")
    return jobs.versioned(raw, ["l_partkey", "l_suppkey"], "dia")


@query("scd2_by_load", f"SELECT *, carga AS valido_de, lead(carga) OVER w - INTERVAL 1 DAY AS valido_ate, lead(carga) OVER w IS NULL AS is_current FROM (SELECT DISTINCT codigo, carga, tipo FROM ({LOADS}) l) d WINDOW w AS (PARTITION BY codigo, tipo ORDER BY carga ASC NULLS LAST)")
def _(spark, d):
    return jobs.load_versions(derive(spark, d, LOADS), ["codigo", "tipo"], "carga")


@query("scd2_as_of", f"SELECT * FROM ({HISTORY}) h WHERE valido_de <= DATE '1996-06-30' AND (valido_ate >= DATE '1996-06-30' OR is_current)")
def _(spark, d):
    return history.as_of(jobs.versioned(derive(spark, d, PURCHASES), ["cod_compra"], "data_atualizacao", VARIANTS), "1996-06-30")


@query("scd2_as_of_pruned", f"SELECT * FROM ({HISTORY}) h WHERE valido_de <= DATE '1996-06-30' AND (valido_ate >= DATE '1996-06-30' OR is_current)")
def _(spark, d):
    """The same from a history laid out by the month its versions end in."""
    base = shared_path(spark, "by-end")
    sinks.history_by_end(jobs.versioned(derive(spark, d, PURCHASES), ["cod_compra"], "data_atualizacao", VARIANTS), base, "1")
    return sinks.history_on(spark, base, "1996-06-30")


@query("load_as_of", f"SELECT codigo, tipo, max(carga) AS carga, max(carga) AS valido_de FROM ({LOADS}) l WHERE carga <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY codigo, tipo")
def _(spark, d):
    return history.loads_as_of(jobs.load_versions(derive(spark, d, LOADS), ["codigo", "tipo"], "carga"), "2024-01-15 12:00:00", ["codigo", "tipo"])


@query("retention_filter", "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def _(spark, d):
    ev = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    return history.retained(ev, "ts", str(ev.agg(F.max("ts")).first()[0]), 7)


@query("retention_drop", "SELECT strftime(ts, '%Y-%m-%d') AS load_ts, count(*) AS n FROM events WHERE date_trunc('day', ts) >= (SELECT max(date_trunc('day', ts)) FROM events) - INTERVAL 7 DAY GROUP BY 1")
def _(spark, d):
    base = shared_path(spark, "loads")
    ev = table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("load_ts"))
    ev.repartition("load_ts").write.partitionBy("load_ts").parquet(base)
    now = ev.agg(F.max("load_ts")).first()[0]
    listed = sinks.drop_expired_loads(spark, base, now, 7)
    assert listed == sinks.drop_expired_loads(spark, base, now, 7, dry_run=False)  # the dry run listed them and left them
    return spark.read.parquet(base).groupBy(F.col("load_ts").cast("string").alias("load_ts")).agg(F.count("*").alias("n"))


@query("yearly_summary", f"SELECT ano_compra, count(*) AS n, sum(valor) AS total_estimado, sum(CASE WHEN situacao = 'F' THEN valor END) AS total_homologado FROM ({HISTORY}) h WHERE is_current GROUP BY ano_compra")
def _(spark, d):
    now = jobs.published(derive(spark, d, PURCHASES), ["cod_compra"], "data_atualizacao", variants=VARIANTS)
    now = now.withColumn("valor_homologado", F.when(F.col("situacao") == "F", F.col("valor")))  # stand-in: closed purchases
    return summaries.yearly_summary(now, "ano_compra", {"total_estimado": "valor", "total_homologado": "valor_homologado"})


@query("rows_per_year", "SELECT CAST(year(o_orderdate) AS INT) AS ano, count(*) AS n, CAST(grouping(CAST(year(o_orderdate) AS INT)) AS INT) AS total FROM orders GROUP BY ROLLUP (CAST(year(o_orderdate) AS INT))")
def _(spark, d):
    return summaries.rows_per_year(table(spark, d, "orders").select(F.year("o_orderdate").alias("y")), "y").select("ano", "n", F.col("total").cast("int").alias("total"))


@query("reconcile_totals", "WITH a AS (SELECT CAST(year(o_orderdate) AS INT) AS ano, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT CAST(year(o_orderdate) AS INT) AS ano, count(*) AS n FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1) SELECT ano, a.n AS n, b.n AS n_ref, coalesce(a.n, 0) - coalesce(b.n, 0) AS n_diff FROM a FULL JOIN b USING (ano)")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("ano", F.year("o_orderdate"))
    count = lambda df: df.groupBy("ano").agg(F.count("*").alias("n"))
    return checks.reconcile(count(o), count(o.where("o_orderkey % 5 <> 0")), ["ano"], ["n"])


@query("table_stats", "SELECT 'nation' AS name, 'table' AS kind, count(*) AS rows, CAST(1 AS BIGINT) AS files FROM nation UNION ALL SELECT 'supplier', 'table', count(*), 1 FROM supplier UNION ALL SELECT 'v', 'view', NULL, NULL")
def _(spark, d):
    return summaries.table_stats({n: table(spark, d, n) for n in ("nation", "supplier")}, ["v"])


@query("top_one", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1")
def _(spark, d):
    return summaries.top_one(table(spark, d, "customer").select("c_custkey", "c_acctbal"), F.desc("c_acctbal"), "c_custkey")


@query("ad_hoc_sql", "SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def _(spark, d):
    return summaries.ad_hoc(spark, "SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name", {n: table(spark, d, n) for n in ("customer", "nation")})


@query("union_all", "SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier")
def _(spark, d):
    return H.union_all(table(spark, d, "customer").select(F.col("c_name").alias("name")), table(spark, d, "supplier").select(F.col("s_name").alias("name")))


@query("union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def _(spark, d):
    return H.union_distinct(table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


# ---- change detection and joins --------------------------------------------------------------------------
_MANIFEST_DIFF = f"""SELECT e.page_id AS page_id, coalesce(o.h, m.hash_sha256) AS hash_sha256, CASE WHEN o.h IS NULL THEN 'indisponivel' WHEN m.page_id IS NULL THEN 'baixado' WHEN o.h = m.hash_sha256 THEN 'ignorado' ELSE 'atualizado' END AS status
  FROM pages e LEFT JOIN (SELECT page_id, sha256(html) AS h FROM pages WHERE page_id % 13 <> 0) o ON o.page_id = e.page_id LEFT JOIN ({MANIFEST.format(hash='sha256(html)')}) m ON m.page_id = e.page_id"""


def _diff(spark, d):
    pages = table(spark, d, "pages")
    observed = pages.where("page_id % 13 <> 0").select("page_id", F.sha2("html", 256).alias("hash_sha256"))
    return changes.manifest_diff(pages.select("page_id"), observed, derive(spark, d, MANIFEST.format(hash="sha2(html, 256)")), ["page_id"])


@query("manifest_diff", _MANIFEST_DIFF)
def _(spark, d):
    return _diff(spark, d)


@query("status_counts", f"SELECT status, count(*) AS n FROM ({_MANIFEST_DIFF}) x GROUP BY status")
def _(spark, d):
    return changes.status_counts(_diff(spark, d))


_OLD = "SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 7 <> 0"


@query("snapshot_diff", f"SELECT n.c_custkey, n.c_name, n.c_acctbal FROM customer n LEFT JOIN ({_OLD}) o ON o.c_custkey = n.c_custkey WHERE o.c_custkey IS NULL OR n.c_name IS DISTINCT FROM o.c_name OR n.c_acctbal IS DISTINCT FROM o.c_acctbal")
def _(spark, d):
    return changes.snapshot_diff(table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), derive(spark, d, _OLD), ["c_custkey"], whole_first=True)


_MOVED = "SELECT c_custkey, CASE WHEN c_custkey % {n} = 0 THEN NULL ELSE c_name END AS nome, CASE WHEN c_custkey % {n} = 0 THEN c_name END AS apelido FROM customer"


@query("snapshot_digests", f"SELECT n.c_custkey, n.c_name, n.c_acctbal FROM customer n LEFT JOIN ({_OLD}) o ON o.c_custkey = n.c_custkey WHERE o.c_custkey IS NULL OR n.c_name IS DISTINCT FROM o.c_name OR n.c_acctbal IS DISTINCT FROM o.c_acctbal")
def _(spark, d):
    """The same difference by digests of buckets that are stored with the snapshot."""
    base = shared_path(spark, "digests")
    sinks.replace_snapshot(derive(spark, d, _OLD), base, "2024-01-01", keys=["c_custkey"])
    return sinks.changes_since(table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), base, ["c_custkey"])


@query("snapshot_diff_moved_nulls", f"SELECT n.* FROM ({_MOVED.format(n=5)}) n JOIN ({_MOVED.format(n=15)}) o ON o.c_custkey = n.c_custkey WHERE n.nome IS DISTINCT FROM o.nome")
def _(spark, d):
    # the tables differ by values that moved to the column beside, a null taking their place
    return changes.snapshot_diff(derive(spark, d, _MOVED.format(n=5)), derive(spark, d, _MOVED.format(n=15)), ["c_custkey"], whole_first=True)


@query("period_calendar", """WITH b AS (SELECT CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS z FROM events),
  c AS (SELECT 'diario' AS granularidade, strftime(g, '%Y-%m-%d') AS periodo FROM b, generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY) t(g)
  UNION ALL SELECT 'mensal', strftime(g, '%Y-%m') FROM b, generate_series(date_trunc('month', CAST(a AS TIMESTAMP)), CAST(z AS TIMESTAMP), INTERVAL 1 MONTH) t(g)
  UNION ALL SELECT 'anual', strftime(g, '%Y') FROM b, generate_series(date_trunc('year', CAST(a AS TIMESTAMP)), CAST(z AS TIMESTAMP), INTERVAL 1 YEAR) t(g))
  SELECT granularidade, periodo, coalesce(n, 0) AS n FROM c LEFT JOIN (SELECT strftime(ts, '%Y-%m-%d') AS periodo, count(*) AS n FROM events GROUP BY 1) e USING (periodo)""")
def _(spark, d):
    ev = table(spark, d, "events")
    a, z = ev.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    days = ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("periodo")).agg(F.count("*").alias("n"))
    return changes.period_calendar(spark, str(a), str(z)).join(days, "periodo", "left").select("granularidade", "periodo", F.coalesce("n", F.lit(0)).alias("n"))


@query("closed_months", "SELECT strftime(g, '%Y-%m') AS periodo, count(o_orderkey) AS n FROM (SELECT date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS z FROM orders) b, generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP) - INTERVAL 1 MONTH, INTERVAL 1 MONTH) t(g) LEFT JOIN orders ON date_trunc('month', o_orderdate) = g GROUP BY g")
def _(spark, d):
    """Months that a drop is expected of, the one that still runs left out, and their rows."""
    o = table(spark, d, "orders")
    a, z = o.agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    months = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("periodo")).agg(F.count("*").alias("n"))
    return changes.period_calendar(spark, str(a), str(z), ("mensal",), last_open=True).join(months, "periodo", "left").select("periodo", F.coalesce("n", F.lit(0)).alias("n"))


@query("latest_by", "SELECT user_id, max_by(event_type, (ts, event_type)) AS event_type FROM events GROUP BY user_id")
def _(spark, d):
    return changes.latest_by(table(spark, d, "events"), "event_type", "ts", ["user_id"])


@query("document_change", "SELECT page_id, page_id % 3 <> 0 OR page_id % 10 = 0 AS mudou FROM pages")
def _(spark, d):
    """Pages read again on another day: those of every third have an entry, every tenth has other content now."""
    pages = table(spark, d, "pages")
    told = lambda html: changes.content_hash({"url": F.col("url"), "html": html})  # noqa: E731  the day isn't part of it
    before = pages.where("page_id % 3 = 0").select("page_id", told(F.col("html")).alias("hash"), F.lit("2024-01-02").alias("extraido_em"))
    older = before.select("page_id", F.lit("0").alias("hash"), F.lit("2024-01-01").alias("extraido_em"))
    now = pages.select("page_id", told(F.when(F.col("page_id") % 10 == 0, F.concat("html", F.lit("!"))).otherwise(F.col("html"))).alias("hash"))
    return changes.document_change(before.unionByName(older), now, "hash", "extraido_em", ["page_id"]).select("page_id", "mudou")


@query("surrogate_id", "SELECT event_id, row_number() OVER (ORDER BY ts ASC NULLS LAST, event_id) AS id FROM events")
def _(spark, d):
    return changes.surrogate_ids(table(spark, d, "events").select("event_id", "ts"), [F.asc_nulls_last("ts"), F.asc("event_id")]).select("event_id", F.col("id").cast("long").alias("id"))


@query("tuple_semi_join", "SELECT o_orderkey FROM orders WHERE (o_orderstatus, o_orderpriority) IN (SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 997 = 0)")
def _(spark, d):
    o = table(spark, d, "orders")
    return sinks.changed_rows(o, o.where("o_orderkey % 997 = 0"), ["o_orderstatus", "o_orderpriority"]).select("o_orderkey")


@query("semi_join", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def _(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return sinks.changed_rows(table(spark, d, "customer"), big, ["c_custkey"]).select("c_custkey")


@query("contains_semi_join", "SELECT page_id FROM pages p WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT regexp_extract(url, '([^/]+)$', 1) AS f FROM pages WHERE page_id % 9 = 0) c WHERE f <> '' AND contains(p.url, c.f))")
def _(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    names = pages.where("page_id % 9 = 0").select(F.regexp_extract("url", "([^/]+)$", 1).alias("arquivo"))
    return sinks.containing_rows(pages, "url", names, "arquivo").select("page_id")


@query("contains_common_beginning", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 50 = 0 AND l_linenumber = 1")
def _(spark, d):
    """File names that all begin alike, sought in paths of files that begin alike too."""
    path = F.concat(F.lit("s3/lake/ncm/ncm_"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("-"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0"), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit(".csv"))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", path.alias("caminho"))
    names = rows.where("l_orderkey % 50 = 0 and l_linenumber = 1").select(F.regexp_extract("caminho", "([^/]+)$", 1).alias("arquivo"))
    return sinks.containing_rows(rows, "caminho", names, "arquivo").select("l_orderkey", "l_linenumber")


@query("dim_join", f"SELECT resolucao, ncm, vigencia_inicio AS data_evento FROM ({SHEETS}) s JOIN ({REGULATIONS}) r ON r.id = s.resolucao")
def _(spark, d):
    return margins.dated(derive(spark, d, SHEETS).select("resolucao", "ncm"), derive(spark, d, REGULATIONS))


# ---- hierarchy -------------------------------------------------------------------------------------------
_KEPT = f"SELECT codigo, descricao FROM ({NODES}) n"
_ENRICHED = "SELECT n.codigo AS codigo, n.descricao AS descricao, CASE length(n.codigo) WHEN 2 THEN 'Capítulo' WHEN 4 THEN 'Posição' WHEN 5 THEN 'Subposição 1' WHEN 6 THEN 'Subposição 2' WHEN 7 THEN 'Item' WHEN 8 THEN 'Subitem' END AS nivel, " + ", ".join(f"a{n}.codigo AS {c}_codigo, a{n}.descricao AS {c}_descricao" for n, c in H.LEVEL_COLUMNS.items()) + ", concat_ws(' > ', 'Nomenclatura Comum do Mercosul', " + ", ".join(f"a{n}.descricao" for n in H.LEVEL_COLUMNS) + f") AS caminho FROM ({NODES}) n " + " ".join(f"LEFT JOIN ({NODES}) a{n} ON length(a{n}.codigo) = {n} AND a{n}.codigo = left(n.codigo, {n})" for n in H.LEVEL_COLUMNS)


@query("tree_enrich", _ENRICHED)
def _(spark, d):
    return H.enrich(derive(spark, d, NODES))


_PREFIXES = f"WITH e AS ({_ENRICHED}) SELECT b.codigo AS prefixo, l.codigo AS codigo, b.descricao AS descricao, b.nivel AS nivel, b.capitulo_codigo AS capitulo_codigo, b.capitulo_descricao AS capitulo_descricao, l.caminho AS caminho FROM e b JOIN e l ON length(l.codigo) = 8 AND left(l.codigo, length(b.codigo)) = b.codigo"


@query("prefix_lookup", _PREFIXES)
def _(spark, d):
    return H.prefix_lookup(H.enrich(derive(spark, d, NODES)))


_ABOVE = " UNION ALL ".join(f"SELECT c.codigo AS codigo, p.codigo AS acima FROM ({_KEPT}) c JOIN ({_KEPT}) p ON length(p.codigo) = {n} AND left(c.codigo, {n}) = p.codigo WHERE length(c.codigo) > {n}" for n in (2, 4, 5, 6, 7))
_PARENTS = f"SELECT k.codigo AS codigo, max_by(acima, length(acima)) AS pai FROM ({_KEPT}) k LEFT JOIN ({_ABOVE}) a ON a.codigo = k.codigo GROUP BY k.codigo"
_DEPTHS = f"SELECT k.codigo AS codigo, count(acima) AS profundidade FROM ({_KEPT}) k LEFT JOIN ({_ABOVE}) a ON a.codigo = k.codigo GROUP BY k.codigo"


@query("tree_parent", _PARENTS)
def _(spark, d):
    return H.parents(derive(spark, d, NODES))


@query("tree_depth", _DEPTHS)
def _(spark, d):
    return H.depth(derive(spark, d, NODES))


@query("tree_child_count", f"SELECT pai AS codigo, count(*) AS n_filhos FROM ({_PARENTS}) x WHERE pai IS NOT NULL GROUP BY pai")
def _(spark, d):
    return H.child_count(derive(spark, d, NODES))


@query("tree_descendant_count", f"SELECT acima AS codigo, count(*) AS n_descendentes FROM ({_ABOVE}) x GROUP BY acima")
def _(spark, d):
    return H.descendant_count(derive(spark, d, NODES))


@query("tree_intervals", f"""WITH k AS (SELECT codigo, row_number() OVER (ORDER BY codigo) AS ordem FROM ({_KEPT}) k), d AS (SELECT acima AS codigo, count(*) AS n FROM ({_ABOVE}) a GROUP BY 1), f AS (SELECT pai AS codigo, count(*) AS n FROM ({_PARENTS}) p GROUP BY 1)
  SELECT k.codigo AS codigo, ordem, ordem + coalesce(d.n, 0) AS fim, profundidade, pai, coalesce(f.n, 0) AS n_filhos, coalesce(d.n, 0) AS n_descendentes FROM k JOIN ({_DEPTHS}) x ON x.codigo = k.codigo JOIN ({_PARENTS}) p ON p.codigo = k.codigo LEFT JOIN d ON d.codigo = k.codigo LEFT JOIN f ON f.codigo = k.codigo""")
def _(spark, d):
    return H.intervals(derive(spark, d, NODES))


@query("tree_prune", f"SELECT codigo, descricao FROM ({_KEPT}) k WHERE codigo IN (SELECT codigo FROM ({_DEPTHS}) x WHERE profundidade <= 2)")
def _(spark, d):
    return H.prune(derive(spark, d, NODES), 2)


@query("tree_search", f"SELECT codigo, descricao FROM ({_KEPT}) k WHERE contains(lower(descricao), 'e bolt')")
def _(spark, d):
    return H.search(derive(spark, d, NODES), "E BOLT")


@query("tree_select", f"SELECT codigo, descricao FROM ({_KEPT}) k WHERE codigo = '00'")
def _(spark, d):
    return H.select_code(derive(spark, d, NODES), "00")


@query("tree_preorder", f"SELECT codigo, descricao FROM ({_KEPT}) k ORDER BY codigo")
def _(spark, d):
    return H.preorder(derive(spark, d, NODES))


@query("flatten_tree", f"SELECT codigo, descricao FROM ({_KEPT}) k")
def _(spark, d):
    """All six levels, nested from the leaves up and flattened again."""
    nodes, lengths = stored(derive(spark, d, NODES), "nodes"), list(H.LEVEL_COLUMNS)
    kids = None
    for n, above in reversed(list(zip(lengths, [None, *lengths], strict=False))):
        level = nodes.where(F.length("codigo") == n).select("codigo", F.struct(F.col("codigo").alias("Codigo"), F.col("descricao").alias("Descricao")).alias("node"))
        told = F.to_json("node")
        if kids is not None:
            level = level.join(kids, "codigo", "left")
            told = F.when(F.col("kids").isNull(), told).otherwise(F.concat(told.substr(F.lit(1), F.length(told) - 1), F.lit(',"NomenclaturaFilha":['), "kids", F.lit("]}")))
        key = F.left("codigo", F.lit(above)) if above else F.left("codigo", F.lit(1))
        kids = level.select(key.alias("codigo"), "codigo", told.alias("told")).toDF("codigo", "own", "told").groupBy("codigo").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("own", "told"))), lambda x: x["told"]), ",").alias("kids"))
    return scans.flatten_tree(kids.select(F.concat(F.lit("["), "kids", F.lit("]")).alias("doc")), "doc")


@query("flatten_deep_tree", "SELECT string_agg('n' || i, '/' ORDER BY i) || '/' || p_partkey AS codigo, p_name AS descricao FROM part, range(9) t(i) WHERE i <= p_partkey % 9 GROUP BY p_partkey, p_name UNION ALL SELECT string_agg('n' || i, '/' ORDER BY i) || '/' || p_partkey || '.' || j, NULL FROM part, range(9) t(i), range(9) u(j) WHERE i <= j AND j < p_partkey % 9 GROUP BY p_partkey, j")
def _(spark, d):
    """A document a part, one to nine levels deep: the last node has the part's name, those above it have none."""
    p, deep = scans.dealt(table(spark, d, "part").select("p_partkey", "p_name")), F.col("p_partkey") % 9
    told = F.lit("{}")  # no part is deeper
    for k in range(8, -1, -1):
        path = F.concat(F.lit("/".join(f"n{i}" for i in range(k + 1)) + "/"), F.col("p_partkey").cast("string"))
        leaf = F.to_json(F.struct(path.alias("Codigo"), F.col("p_name").alias("Descricao")))
        inner = F.to_json(F.struct(F.concat(path, F.lit(f".{k}")).alias("Codigo")))
        nested = F.concat(inner.substr(F.lit(1), F.length(inner) - 1), F.lit(',"NomenclaturaFilha":['), told, F.lit("]}"))
        told = F.when(deep == k, leaf).otherwise(nested)
    return scans.flatten_tree(p.select(F.concat(F.lit("["), told, F.lit("]")).alias("doc")), "doc")


# ---- margins and translator ------------------------------------------------------------------------------
_EVENT = """SELECT {reg} AS resolucao, '{kind}' AS tipo_evento_margem, '{type}' AS tipo_margem, trim(ncm) AS prefixo_ncm, trim(regra_de_origem) AS margem_normal_comprovante, round(try_cast(trim(margem_normal) AS DOUBLE) / 100, 4) AS margem_normal_pct,
  {proof} AS margem_adicional_comprovante, {extra} AS margem_adicional_pct, trim(grupo_de_produtos) AS grupo_de_produtos, trim(comentario) AS comentario FROM ({rows}) s WHERE trim(ncm) <> '' AND {where}"""


def _event_sql(rows: str, reg: str, kind: str, where: str, content_where: str) -> str:
    content = _EVENT.format(reg=reg, kind=kind, type="conteudo_nacional", proof="CAST(NULL AS VARCHAR)", extra="CAST(NULL AS DOUBLE)", rows=rows, where=f"{where} AND {content_where}")
    return content + " UNION ALL " + _EVENT.format(reg=reg, kind=kind, type="tecnologia_nacional", proof="replace(trim(regra_de_qualificacao), ' ', '_')", extra="round(try_cast(trim(margem_adicional) AS DOUBLE) / 100, 4)", rows=rows, where=f"{where} AND trim(margem_adicional) <> ''")


_SUCCESSION = _event_sql(SHEETS, "resolucao", "habilita", "true", "true") + " UNION ALL " + " UNION ALL ".join(_event_sql(SHEETS, f"'{b}'", "desabilita", f"resolucao = '{a}'", "true") for a, b in zip(SUCCESSION, SUCCESSION[1:], strict=False))
_STANDING = _event_sql(STANDING, "resolucao", "habilita", "true", "trim(margem_normal) <> ''")
_REST = "resolucao ASC NULLS LAST, tipo_margem ASC NULLS LAST, margem_normal_comprovante ASC NULLS LAST, margem_normal_pct ASC NULLS LAST, margem_adicional_comprovante ASC NULLS LAST, margem_adicional_pct ASC NULLS LAST, grupo_de_produtos ASC NULLS LAST, comentario ASC NULLS LAST"
_TABLE = f"""SELECT row_number() OVER (ORDER BY data_evento, tipo_evento_margem, prefixo_ncm) AS id_evento_margem, * EXCLUDE (rn) FROM (SELECT e.*, r.vigencia_inicio AS data_evento, CAST(NULL AS DECIMAL(3,2)) AS margem_sustentabilidade_pct,
  row_number() OVER (PARTITION BY prefixo_ncm, r.vigencia_inicio, tipo_evento_margem ORDER BY margem_normal_pct + coalesce(margem_adicional_pct, 0) DESC NULLS LAST, {_REST}) AS rn FROM ({_SUCCESSION} UNION ALL {_STANDING}) e JOIN ({REGULATIONS}) r ON r.id = e.resolucao) x WHERE rn = 1"""
_INTERVALS = f"""SELECT * EXCLUDE (fam, proxima, tipo_evento_margem, data_evento, id_evento_margem, rn), rn = 1 AS ultima, rn = 1 AND data_fim IS NULL AS ativa FROM (SELECT *, row_number() OVER (PARTITION BY fam, prefixo_ncm ORDER BY data_inicio DESC NULLS LAST) AS rn FROM (
  SELECT *, data_evento AS data_inicio, CAST(proxima - 1 AS DATE) AS data_fim FROM (SELECT *, starts_with(resolucao, 'cics') AS fam, lead(data_evento) OVER (PARTITION BY starts_with(resolucao, 'cics'), prefixo_ncm, tipo_margem ORDER BY data_evento, tipo_evento_margem) AS proxima FROM ({_TABLE}) t) a WHERE tipo_evento_margem = 'habilita') b) c"""


def _events(spark, d):
    return margins.event_table(margins.succession_events(derive(spark, d, SHEETS), SUCCESSION), margins.sheet_events(derive(spark, d, STANDING), True), derive(spark, d, REGULATIONS))


@query("margin_events", _SUCCESSION)
def _(spark, d):
    return margins.succession_events(derive(spark, d, SHEETS), SUCCESSION)


@query("margin_events_no_disable", _STANDING)
def _(spark, d):
    return margins.sheet_events(derive(spark, d, STANDING), True)


@query("margin_event_table", _TABLE)
def _(spark, d):
    return _events(spark, d).withColumn("id_evento_margem", F.col("id_evento_margem").cast("long"))


@query("dedup_top_value", f"SELECT * EXCLUDE (id_evento_margem, rn) FROM (SELECT *, row_number() OVER (PARTITION BY prefixo_ncm, data_evento ORDER BY margem_normal_pct + coalesce(margem_adicional_pct, 0) DESC NULLS LAST, resolucao ASC NULLS LAST, tipo_evento_margem ASC NULLS LAST) AS rn FROM ({_TABLE}) t) x WHERE rn = 1")
def _(spark, d):
    ev = _events(spark, d).drop("id_evento_margem")
    first = ["resolucao", "tipo_evento_margem"]
    ev = ev.select("prefixo_ncm", "data_evento", *first, *(c for c in ev.columns if c not in ("prefixo_ncm", "data_evento", *first)))
    return dedup.keep_top_value(ev, ["prefixo_ncm", "data_evento"], ["margem_normal_pct", "margem_adicional_pct"])


@query("event_intervals", f"SELECT prefixo_ncm, tipo_margem, resolucao, data_inicio, data_fim FROM ({_INTERVALS}) i")
def _(spark, d):
    ev = _events(spark, d).withColumn("fam", F.col("resolucao").startswith("cics"))
    return history.event_intervals(ev, ["fam", "prefixo_ncm", "tipo_margem"], "data_evento", "tipo_evento_margem", "habilita").select("prefixo_ncm", "tipo_margem", "resolucao", "data_inicio", "data_fim")


@query("latest_active_flags", _INTERVALS)
def _(spark, d):
    return margins.margin_intervals(_events(spark, d))


@query("active_margins", f"WITH p AS ({_PREFIXES}), i AS ({_INTERVALS}) SELECT i.*, p.codigo AS ncm, p.descricao AS ncm_descricao FROM i JOIN p ON p.prefixo = i.prefixo_ncm WHERE starts_with(i.resolucao, 'cics') AND i.ativa")
def _(spark, d):
    return jobs.margin_marts(derive(spark, d, SHEETS), derive(spark, d, STANDING), derive(spark, d, REGULATIONS), H.prefix_lookup(H.enrich(derive(spark, d, NODES))), SUCCESSION)["cics"]


@query("active_margins_ciiapac", f"WITH p AS ({_PREFIXES}), i AS ({_INTERVALS}) SELECT i.*, p.codigo AS ncm, p.descricao AS ncm_descricao FROM i JOIN p ON p.prefixo = i.prefixo_ncm WHERE starts_with(i.resolucao, 'ciiapac') AND i.ativa")
def _(spark, d):
    return jobs.margin_marts(derive(spark, d, SHEETS), derive(spark, d, STANDING), derive(spark, d, REGULATIONS), H.prefix_lookup(H.enrich(derive(spark, d, NODES))), SUCCESSION)["ciiapac"]


_STAGED = f"SELECT CAST(trim(catmat) AS INT) AS catmat, trim(catmat_descr) AS catmat_descr, nullif(trim(ncm), '-') AS ncm, trim(ncm_capitulo_sugerido_cod) AS ncm_capitulo_sugerido_cod, trim(ncm_posicao_sugerida_cod) AS ncm_posicao_sugerida_cod, string_split(trim(ncm_subitem_sugerido_top_5_cod), ',') AS ncm_subitem_sugerido_top_5_cod, string_split(trim(ncm_subitem_sugerido_top_5_descr), '|') AS ncm_subitem_sugerido_top_5_descr FROM ({SUGGESTIONS}) s WHERE trim(catmat) <> ''"


@query("translator_stage", f"SELECT * REPLACE (array_to_string(ncm_subitem_sugerido_top_5_cod, ';') AS ncm_subitem_sugerido_top_5_cod, array_to_string(ncm_subitem_sugerido_top_5_descr, ';') AS ncm_subitem_sugerido_top_5_descr) FROM ({_STAGED}) t")
def _(spark, d):
    out = translator.stage_suggestions(derive(spark, d, SUGGESTIONS))
    return out.withColumns({c: F.array_join(c, ";") for c in ("ncm_subitem_sugerido_top_5_cod", "ncm_subitem_sugerido_top_5_descr")})


_RESOLVED = f"""SELECT catmat, CASE WHEN ncm IS NOT NULL THEN left(ncm, 2) ELSE ncm_capitulo_sugerido_cod END AS capitulo_ncm, CASE WHEN ncm IS NULL THEN ncm_posicao_sugerida_cod WHEN length(ncm) >= 4 THEN left(ncm, 4) END AS posicao_ncm,
  CASE WHEN ncm IS NULL THEN ncm_subitem_sugerido_top_5_cod[1] WHEN length(ncm) = 8 THEN ncm END AS subitem_ncm, CASE WHEN ncm IS NOT NULL THEN 'humano' WHEN ncm_capitulo_sugerido_cod IS NOT NULL THEN 'ia' END AS metodo_de_mapeamento FROM ({_STAGED}) t"""


@query("translator_resolve", _RESOLVED)
def _(spark, d):
    return jobs.translated(derive(spark, d, SUGGESTIONS))


# ---- quality ---------------------------------------------------------------------------------------------
@query("dq_not_null", f"SELECT * FROM (SELECT 'prioridade' AS \"column\", count(*) FILTER (prioridade IS NULL) AS n FROM ({PLAIN}) p UNION ALL SELECT 'valor', count(*) FILTER (valor IS NULL) FROM ({PLAIN}) q) x WHERE n > 0")
def _(spark, d):
    return checks.null_violations(derive(spark, d, PLAIN), ["prioridade", "valor"])


@query("dq_unique", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def _(spark, d):
    return checks.repeated_values(table(spark, d, "orders"), ["o_custkey"])


@query("dq_accepted_values", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus")
def _(spark, d):
    return checks.values_outside(table(spark, d, "orders"), "o_orderstatus", ["F", "O"])


@query("dq_quarantine", f"SELECT *, CASE WHEN prioridade IS NULL AND situacao NOT IN ('F', 'O') THEN 'prioridade;situacao' WHEN prioridade IS NULL THEN 'prioridade' ELSE 'situacao' END AS regras FROM ({PLAIN}) p WHERE prioridade IS NULL OR situacao NOT IN ('F', 'O')")
def _(spark, d):
    """Rows that break a rule, set aside by the job that writes the others, whose counts it tells."""
    base, rows = shared_path(spark, "checked"), derive(spark, d, PLAIN)
    told = sinks.checked_snapshot(rows, base, "1", {"prioridade": F.col("prioridade").isNotNull(), "situacao": F.col("situacao").isin("F", "O")})
    aside = sinks.quarantined(spark, base)
    assert told["rows"] == sinks.checked(spark, base).count() + aside.count()
    return aside.withColumn("regras", F.array_join("_broken", ";")).drop("_broken")


CONTRACT = T.StructType([T.StructField("catmat", T.IntegerType()), *(T.StructField(c, T.StringType()) for c in ("capitulo_ncm", "posicao_ncm", "subitem_ncm", "metodo_de_mapeamento"))])


@query("schema_contract", _RESOLVED)
def _(spark, d):
    return checks.enforce_contract(jobs.translated(derive(spark, d, SUGGESTIONS)), CONTRACT)


# ---- sources and sinks: written, read again --------------------------------------------------------------
_ORDER_COLUMNS = "o_orderkey long, o_orderstatus string, o_totalprice double"
_ORDERS3 = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"


@query("csv_to_parquet", _ORDERS3)
def _(spark, d):
    src = shared_path(spark, "csv")
    table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").write.option("header", True).csv(src)
    return scans.csv_to_parquet(spark, src, shared_path(spark, "parquet"), _ORDER_COLUMNS)


@query("csv_by_header", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice, CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS nota FROM orders")
def _(spark, d):
    """Drops whose headers name the columns in another order, one too few or one too many."""
    base, o = shared_path(spark, "headers"), table(spark, d, "orders")
    drops = (["o_orderkey", "o_orderstatus", "o_totalprice"], ["o_totalprice", "O_ORDERKEY", "nota", "o_orderstatus"], ["o_totalprice", "o_orderkey"])
    for k, columns in enumerate(drops):
        part = o.where(F.col("o_orderkey") % 3 == k).withColumn("nota", F.col("o_orderpriority"))
        part.select(*columns).write.option("header", True).csv(f"{base}/drop={k}")
    return scans.read_csv(spark, f"{base}/*", _ORDER_COLUMNS, unknown="keep")


@query("csv_multiline", "SELECT doc_id, lang, text FROM documents")
def _(spark, d):
    src = shared_path(spark, "lines")
    plain = {"header": True, "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    table(spark, d, "documents").select("doc_id", "lang", "text").write.options(**plain).csv(src)
    return scans.csv_to_parquet(spark, src, shared_path(spark, "parquet"), "doc_id long, lang string, text string", multi_line=True)


@query("csv_latin1", "SELECT page_id, regexp_extract(html, '<title>([^<]*)', 1) AS titulo FROM pages")
def _(spark, d):
    src = shared_path(spark, "latin1")
    table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)", 1).alias("titulo")).write.option("header", True).option("sep", ";").option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("encoding", "ISO-8859-1").csv(src)
    out = scans.read_csv(spark, src, "page_id long, titulo string", sep=";", encoding="ISO-8859-1", multi_line=True)
    return out.select("page_id", F.coalesce("titulo", F.lit("")).alias("titulo"))


_DRIFT = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType()), T.StructField("v", T.DoubleType())])


@query("union_by_name_scan", "SELECT o_orderkey AS k, o_orderstatus AS s, CAST(NULL AS DOUBLE) AS v FROM orders UNION ALL SELECT c_custkey, CAST(c_custkey AS VARCHAR), c_acctbal FROM customer")
def _(spark, d):
    a, b = shared_path(spark, "drift"), shared_path(spark, "drift")
    table(spark, d, "orders").select(F.col("o_orderkey").cast("int").alias("K"), F.col("o_orderstatus").alias("s")).write.parquet(a)
    table(spark, d, "customer").select("c_acctbal", "c_custkey").select(F.col("c_acctbal").alias("v"), F.col("c_custkey").alias("s"), F.col("c_custkey").cast("string").alias("k")).write.parquet(b)
    return scans.union_by_name([spark.read.parquet(a), spark.read.parquet(b)], _DRIFT)


@query("file_name_keys", "SELECT 'anual' AS granularidade, strftime(o_orderdate, '%Y') AS periodo, count(*) AS n FROM orders GROUP BY 2")
def _(spark, d):
    base, orders = shared_path(spark, "drops"), table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("ano"))
    years = orders.agg(F.min("ano"), F.max("ano")).first()
    for y in range(years[0], years[1] + 1):  # a drop a year, under the names that drops have
        orders.where(F.col("ano") == y).select("o_orderkey").write.parquet(f"{base}/drop-anual-compras/compras-{y}.parquet")
    return scans.with_file_keys(spark.read.parquet(f"{base}/drop-*/*.parquet"), "compras").groupBy("granularidade", "periodo").agg(F.count("*").alias("n"))


@query("csv_glob_versions", "SELECT o_orderpriority AS versao, o_orderkey FROM orders")
def _(spark, d):
    src = shared_path(spark, "versions")
    table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("versao")).write.partitionBy("versao").option("header", True).csv(src)
    out = scans.read_csv(spark, f"{src}/*", "o_orderkey long", path_col="path")
    return out.select(F.url_decode(F.regexp_extract("path", "versao=([^/]+)/", 1)).alias("versao"), "o_orderkey")


@query("catalog_scan", "SELECT p_partkey, p_name, p_size FROM part")
def _(spark, d):
    src = shared_path(spark, "catalog")
    table(spark, d, "part").select("p_partkey", "p_name", "p_size").write.option("header", True).csv(src)
    return scans.read_csv(spark, src, "p_partkey long, p_name string, p_size int")


@query("sheet_scan", f"SELECT ncm, margem_normal FROM ({SHEETS}) s WHERE resolucao = 'cics_1'")
def _(spark, d):
    src = shared_path(spark, "sheets")
    rows = derive(spark, d, SHEETS).select("resolucao", "ncm", "margem_normal").withColumnRenamed("resolucao", "sheet")
    rows.write.partitionBy("sheet").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(src)
    return scans.read_sheet(spark, src, "cics_1", ["ncm", "margem_normal"]).select("ncm", F.coalesce("margem_normal", F.lit("")).alias("margem_normal"))


@query("explode_payload", "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '2024-05-01' AS api_consultada_em FROM events")
def _(spark, d):
    pages = table(spark, d, "events").select(F.concat(F.lit('{"itens":['), "props", F.lit("]}")).alias("payload"))
    return scans.explode_payload(pages, "payload", "k: bigint", "itens", "2024-05-01")


@query("file_metrics", "SELECT p_brand AS marca, CAST(sum(strlen(p_name) + 1) AS BIGINT) AS tamanho_bytes, sha256(string_agg(p_name || chr(10), '' ORDER BY p_partkey)) AS hash_sha256, count(*) AS num_linhas, 1 AS num_colunas FROM part GROUP BY p_brand")
def _(spark, d):
    src = shared_path(spark, "metrics")
    parts = table(spark, d, "part").repartition("p_brand").sortWithinPartitions("p_brand", "p_partkey")
    parts.select("p_name", "p_brand").write.partitionBy("p_brand").text(src)
    told = scans.file_metrics(spark, f"{src}/*/*.txt", spark.read.schema("value string").text(f"{src}/*/*.txt"))
    return told.select(F.url_decode(F.regexp_extract("path", "p_brand=([^/]+)/", 1)).alias("marca"), "tamanho_bytes", "hash_sha256", "num_linhas", "num_colunas")


@query("incremental_append", "SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(spark, d):
    target, lists, delta = (shared_path(spark, n) for n in ("append", "changes", "delta"))
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    o.write.parquet(delta)
    o = spark.read.parquet(f"{delta}/*.parquet")  # drops and change lists are files, read as such
    o.where("o_orderstatus = 'F'").select("o_orderstatus").distinct().write.option("header", True).csv(lists)
    changed = scans.read_csv(spark, lists, "o_orderstatus string")
    sinks.incremental_append(o, changed.limit(0), ["o_orderstatus"], target, run="1")
    sinks.incremental_append(o, changed.limit(0), ["o_orderstatus"], target, run="2")
    sinks.incremental_append(o, changed, ["o_orderstatus"], target, run="3")
    return sinks.incremental_append(o, changed, ["o_orderstatus"], target, run="3")  # tried again, counted once


@query("append_compacted", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark, d):
    """A run a status, then one folder in place of theirs, and those gone."""
    from ..sources import commits

    base, o = shared_path(spark, "compact"), table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    for status in [r[0] for r in o.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect()]:
        sinks.append_once(o.where(F.col("o_orderstatus") == status), base, status)
    now = commits.compact(spark, base, o.schema)
    commits.vacuum(spark, base, keep=1, idle_hours=0, dry_run=False)
    return commits.committed(spark, base, o.schema, now)


@query("full_refresh", "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0")
def _(spark, d):
    name, c = shared_table(spark, "refresh"), table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_name")
    sinks.refresh_table(c, name)
    sinks.refresh_table(c.where("c_custkey % 2 = 0"), name)
    return scans.catalog_table(spark, name, ["c_custkey", "c_acctbal"])


@query("jdbc_scan", "SELECT o_orderkey * o_orderkey AS chave, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0 UNION ALL SELECT NULL, o_orderstatus FROM orders WHERE o_orderkey % 10 = 0")
def _(spark, d):
    """A table of a database (that Spark ships), its key far from evenly spread and missing in places."""
    url, o = f"jdbc:derby:memory:{shared_table(spark, 'db')};create=true", table(spark, d, "orders")
    key = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey").cast("long") * F.col("o_orderkey"))
    options = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    o.select(key.alias("chave"), "o_orderstatus").coalesce(1).write.jdbc(url, "pedidos", properties=options)
    return scans.jdbc_table(spark, url, "pedidos", "chave", 8, **options).select("chave", "o_orderstatus")


@query("published_view", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment")
def _(spark, d):
    name, view = shared_table(spark, "base"), shared_table(spark, "view")
    sinks.refresh_table(table(spark, d, "customer"), name)
    return sinks.publish_view(spark, view, f"SELECT c_mktsegment, count(*) AS n FROM {name} WHERE c_acctbal > 0 GROUP BY c_mktsegment")


@query("delta_by_load", f"SELECT c_custkey, c_acctbal, '2024-01-01' AS carga FROM ({_OLD}) a UNION ALL SELECT n.c_custkey, n.c_acctbal, '2024-01-02' FROM customer n LEFT JOIN ({_OLD}) o ON o.c_custkey = n.c_custkey WHERE o.c_custkey IS NULL OR n.c_acctbal IS DISTINCT FROM o.c_acctbal")
def _(spark, d):
    base, old = shared_path(spark, "loads"), derive(spark, d, _OLD)
    sinks.write_delta(changes.snapshot_diff(old, None, ["c_custkey"]), base, "2024-01-01")
    sinks.write_delta(changes.snapshot_diff(table(spark, d, "customer").select(*old.columns), old, ["c_custkey"], whole_first=True), base, "2024-01-02")
    return spark.read.parquet(base).select("c_custkey", "c_acctbal", F.col("load_ts").cast("string").alias("carga"))


@query("manifest_commit", f"SELECT page_id, hash_sha256, status IN ('baixado', 'atualizado') AS mudou FROM ({_MANIFEST_DIFF}) x WHERE status <> 'indisponivel' OR hash_sha256 IS NOT NULL")
def _(spark, d):
    """A run over a manifest: what it finds is saved as the next version beside its change list."""
    base, lists = shared_path(spark, "manifest"), shared_path(spark, "changed")
    sinks.save_manifest(derive(spark, d, MANIFEST.format(hash="sha2(html, 256)")), ["page_id"], base, "1")
    pages, known = table(spark, d, "pages"), sinks.current_snapshot(spark, base)
    observed = pages.where("page_id % 13 <> 0").select("page_id", F.sha2("html", 256).alias("hash_sha256"))
    diff = changes.manifest_diff(pages.select("page_id"), observed, known, ["page_id"])
    sinks.export_table(changes.change_list(diff, ["page_id"]), lists)
    sinks.save_manifest(diff.where("hash_sha256 is not null").drop("status"), ["page_id"], base, "2")
    saved = spark.read.parquet(lists).withColumn("_changed", F.lit(True))
    return sinks.current_snapshot(spark, base).join(saved, "page_id", "left").select("page_id", "hash_sha256", F.coalesce("_changed", F.lit(False)).alias("mudou"))


@query("export_table", _ORDERS3)
def _(spark, d):
    return sinks.export_table(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), shared_path(spark, "export"))


@query("snapshot_switch", "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0")
def _(spark, d):
    base = shared_path(spark, "snapshot")
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    sinks.replace_snapshot(c, base, "9")
    sinks.replace_snapshot(c.where("c_custkey % 2 = 0"), base, "10")  # newer, though not as text
    return sinks.current_snapshot(spark, base)


@query("stream_append", "SELECT event_id, user_id FROM events")
def _(spark, d):
    from ..streaming.append import append_new_files

    src, target, marks = (shared_path(spark, f"stream-{n}") for n in ("in", "out", "marks"))
    ev = table(spark, d, "events").select("event_id", "user_id")
    ev.where("event_id % 2 = 0").write.parquet(src)
    append_new_files(spark, src, ev.schema, target, marks)
    ev.where("event_id % 2 <> 0").write.mode("append").parquet(src)
    append_new_files(spark, src, ev.schema, target, marks)
    return spark.read.parquet(target).select("event_id", "user_id")


@query("stream_changes", """WITH o AS (SELECT page_id, k AS visto_em, sha256(CASE WHEN k > '1' AND page_id % 5 = 0 THEN html || k ELSE html END) AS h FROM pages, (VALUES ('1'), ('2'), ('3')) t(k) WHERE k <> '1' OR page_id % 3 <> 0)
  SELECT page_id, h AS hash_sha256, visto_em, CASE WHEN p IS NULL THEN 'baixado' WHEN p = h THEN 'ignorado' ELSE 'atualizado' END AS status FROM (SELECT *, lag(h) OVER (PARTITION BY page_id ORDER BY visto_em) AS p FROM o) x""")
def _(spark, d):
    """Three looks at pages, one a run: some pages come later, some change, and each run goes on from the checkpoint."""
    from ..sources.commits import committed
    from ..streaming.changed import changed

    looks, target, marks = (shared_path(spark, f"looks-{n}") for n in ("in", "out", "marks"))
    pages, schema = table(spark, d, "pages"), "page_id long, visto_em string, hash_sha256 string"
    for k in "123":
        seen = pages.where(F.lit(k != "1") | (F.col("page_id") % 3 != 0))
        now = F.when(F.lit(k > "1") & (F.col("page_id") % 5 == 0), F.concat("html", F.lit(k))).otherwise(F.col("html"))
        seen.select("page_id", F.lit(k).alias("visto_em"), F.sha2(now, 256).alias("hash_sha256")).write.mode("append").parquet(looks)
        changed(spark, looks, schema, target, marks, ["page_id"])
    return committed(spark, target, T.StructType.fromDDL("page_id long, hash_sha256 string, visto_em string, status string"))


@query("stream_windows", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n FROM events WHERE time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1, 2")
def _(spark, d):
    from ..sources.commits import committed
    from ..streaming.append import closed_windows

    src, target, marks = (shared_path(spark, f"windows-{n}") for n in ("in", "out", "marks"))
    ev = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    ev.write.parquet(src)
    closed_windows(spark, src, ev.schema, target, marks, "ts", "1 day", "1 hour", "event_type")
    return committed(spark, target, T.StructType.fromDDL("window_start timestamp, event_type string, n long"))


@query("window_counts", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, d):
    from ..streaming.append import late_counts

    return late_counts(table(spark, d, "events"), "ts", "1 day", "1 hour", "event_type")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases by year from raw drops: variants, duplicates, versions, current rows, exact sums."""
    return QUERIES["yearly_summary"](spark, sf_dir)
