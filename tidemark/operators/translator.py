"""Material codes to product codes: typed suggestions, a human's code before the model's."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import not_blank, strict_cast, trimmed

#: Text columns of the sheet in order, and what they become: kind and name (fixed values).
COLUMNS = (("int", "grupo_cod"), ("text", "grupo_descr"), ("int", "classe_cod"), ("text", "classe_descr"), ("int", "pdm_cod"), ("text", "pdm_nome"), ("int", "catmat"), ("text", "catmat_descr"),
           ("dash", "ncm"), ("text", "ncm_capitulo_sugerido_cod"), ("text", "ncm_capitulo_sugerido_descr"), ("text", "ncm_posicao_sugerida_cod"), ("text", "ncm_posicao_sugerida_descr"),
           (",", "ncm_subitem_sugerido_top_5_cod"), ("|", "ncm_subitem_sugerido_top_5_descr"))


def stage_suggestions(raw: DataFrame, key: str = "catmat") -> DataFrame:
    """raw (text columns under the names of COLUMNS) typed: numbers fail if they aren't any, '-' is no code,
    lists are split. Rows with a blank key drop out; columns that raw lacks stay out."""
    kinds = {
        "int": lambda c: strict_cast(c, "int"),
        "text": trimmed,
        "dash": lambda c: F.nullif(trimmed(c), F.lit("-")),
        ",": lambda c: F.split(trimmed(c), ","),
        "|": lambda c: F.split(trimmed(c), r"\|"),
    }
    have = set(raw.columns)
    return not_blank(raw, key).select(*(kinds[k](c).alias(c) for k, c in COLUMNS if c in have))


def resolve_codes(staged: DataFrame) -> DataFrame:
    """catmat, capitulo_ncm, posicao_ncm, subitem_ncm, metodo_de_mapeamento: a human's code at the depth it
    has and nothing of the suggestion beside it; else the suggestion with the first of its leaf codes."""
    human, has = F.col("ncm"), F.col("ncm").isNotNull()
    pick = lambda told, suggested: F.when(has, told).otherwise(suggested)
    return staged.select(
        "catmat",
        pick(F.left(human, F.lit(2)), F.col("ncm_capitulo_sugerido_cod")).alias("capitulo_ncm"),
        pick(F.when(F.length(human) >= 4, F.left(human, F.lit(4))), F.col("ncm_posicao_sugerida_cod")).alias("posicao_ncm"),
        pick(F.when(F.length(human) == 8, human), F.get("ncm_subitem_sugerido_top_5_cod", F.lit(0))).alias("subitem_ncm"),
        pick(F.lit("humano"), F.when(F.col("ncm_capitulo_sugerido_cod").isNotNull(), F.lit("ia"))).alias("metodo_de_mapeamento"),
    )
