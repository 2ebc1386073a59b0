"""Source feeds: each one is a table of columns (SQL expressions over the raw feed) that turns it into the
common product schema. Values of all feeds pass the same vocabularies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.operators.kit import latest

COMMON = [
    "code", "alternatives", "name", "brand", "maker", "ingredient", "dosage", "description", "kind", "stripe", "categories",
    "is_medicine", "is_striped", "is_otc", "is_controlled", "age_group", "registration", "source",
]

# Regulatory kinds as feeds spell them, and the common spelling.
KINDS = {
    "Genérico": "Medicamento Genérico - Lei 9.787/99", "GENERICO": "Medicamento Genérico - Lei 9.787/99",
    "Referência": "Medicamento Referência", "Novo": "Medicamento Referência",
    "Similar": "Medicamento Similar", "SIMILAR": "Medicamento Similar",
    "Similar Intercambiável": "Medicamento Similar Intercambiável",
    "Radiofármaco": "Medicamento Radiofármaco", "Radio fármaco": "Medicamento Radiofármaco",
    "Fitoterápico": "Medicamento Fitoterápico", "Biológico": "Medicamento Biológico", "BIOLOGICO": "Medicamento Biológico",
    "Específico": "Medicamento Específico", "Dinamizado": "Medicamento Dinamizado",
    "BAIXO RISCO": "Medicamento de Baixo Risco", "Produto de Terapia Avançada": "Produto de Terapia Avançada",
}
# Regulatory stripes.
BLACK, RED, RED_RESTRICTED, NO_STRIPE = "Preta", "Vermelha", "Vermelha Sob Restrição", "Sem Tarja"


def stripe(c: Column) -> Column:
    """Regulatory stripe from any feed's wording."""
    t = F.lower(c)
    return (
        F.when(F.contains(t, F.lit("preta")), BLACK)
        .when(t.rlike("restri[cç]|com retencao"), RED_RESTRICTED)
        .when(F.contains(t, F.lit("vermelh")), RED)
        .when(t.rlike("sem tarja|nao tarjado"), NO_STRIPE)
    )


def age_group(c: Column) -> Column:
    """Recommended age group from a restriction text."""
    t = F.lower(c)
    adult, child = F.contains(t, F.lit("adulto")), F.contains(t, F.lit("pedi"))
    return (
        F.when((adult & child) | F.contains(t, F.lit("venda sem")), "todos")
        .when(F.contains(t, F.lit("60 anos")), "idoso").when(adult, "adulto").when(child, "crianca"))


@dataclass(frozen=True)
class Feed:
    """How a raw feed becomes common columns. `codes` lists the raw code columns (each set one becomes a row,
    the others its alternatives); `columns` maps common columns to SQL over the raw feed; `stripe_text` and
    `age_text` are SQL for the wording to classify; `is_medicine` is SQL."""

    source: str
    codes: Sequence[str]
    columns: dict[str, str]
    is_medicine: str = "true"
    stripe_text: str | None = None
    age_text: str | None = None
    alternatives: str | None = None
    flags: dict[str, str] = field(default_factory=dict)
    required: Sequence[str] = ("code",)


FEEDS = {
    "RD": Feed("RD", ["ean"], {
        "name": "name", "brand": "marca", "maker": "fabricante", "ingredient": "principioativonovo", "dosage": "dosagem",
        "description": "regexp_replace(regexp_replace(description, '<[^>]*>', ' '), '(_x[0-9A-F]{4})+_', '')",
        "categories": "breadcrumb"}, is_medicine="coalesce(codtarja, 0) > 0", stripe_text="CASE WHEN coalesce(codtarja, 0) > 0 THEN descricaotarja END",
        flags={"is_striped": "coalesce(codtarja, 0) > 1"}),
    "MINAS_MAIS": Feed("MINAS_MAIS", ["ean_preferencial"], {"maker": "laboratorio"}, is_medicine="CAST(NULL AS BOOLEAN)",
        alternatives="filter(transform(split(eans_cadastrados, ','), x -> trim(x)), x -> x <> '')", required=("code", "maker")),
    "IQVIA": Feed("IQVIA", ["CAST(CAST(cd_ean AS BIGINT) AS STRING)"], {
        "name": "apresentacao", "brand": "produto", "maker": "laboratorio", "ingredient": "nullif(molecula_br, 'N/I')",
        "categories": "CASE WHEN cc_1_desc <> 'NOT OTC' THEN array(array_join(array_distinct(array_compact(array(cc_1_desc, cc_2_desc, cc_3_desc, cc_4_desc))), ' -> ')) END"},
        is_medicine="fg_medicamento", flags={"is_striped": "otc_rx <=> 'E'"}),
    "Anvisa": Feed("Anvisa", ["nullif(trim(ean_1), '-')", "nullif(trim(ean_2), '-')"], {
        "name": "concat(produto, ', ', apresentacao)", "brand": "produto", "maker": "laboratorio",
        "ingredient": "CASE WHEN length(substancia) < 1000 THEN substancia END", "kind": "nullif(trim(tipo_de_produto), '-')"},
        stripe_text="tarja", flags={"is_controlled": "tarja = 'Tarja Preta'", "is_otc": "NULL"}),
    "Farmarcas": Feed("Farmarcas", ["codigo_barras_principal"], {
        "name": "concat(trim(TRAILING '>' FROM descricao), ' ', apresentacao)", "brand": "trim(TRAILING '>' FROM descricao)",
        "maker": "fabricante", "ingredient": "substancia_nome", "dosage": "concentracao",
        "kind": "CASE WHEN grupo_principal IN ('GENERICO', 'SIMILAR') THEN grupo_principal END",
        "description": "concat('Descrição: ', ncm_descricao, '\\nTipo produto: ', tipo_produto, '\\nGrupo: ', grupo_principal)"},
        is_medicine="grupo_principal IN ('PROPAGADO', 'SIMILAR', 'GENERICO', 'MANIPULADO')",
        flags={
            "is_otc": "CASE WHEN grupo_principal NOT IN ('PROPAGADO', 'SIMILAR', 'GENERICO', 'MANIPULADO') OR contains(tipo_produto, 'OTC/MIP') THEN true WHEN tipo_produto RLIKE 'RX|CONTROLADO' THEN false END",
            "is_controlled": "CASE WHEN grupo_principal NOT IN ('PROPAGADO', 'SIMILAR', 'GENERICO', 'MANIPULADO') THEN false WHEN tipo_produto RLIKE 'RX|CONTROLADO' THEN true WHEN contains(tipo_produto, 'OTC/MIP') THEN false END"}),
    "AnvisaMedicamentos": Feed("AnvisaMedicamentos", ["nullif(trim(ean_1), '-')", "nullif(trim(ean_2), '-')", "nullif(trim(ean_3), '-')"], {
        "name": "concat(produto, ' ', apresentacao)", "brand": "upper(produto)", "maker": "laboratorio", "registration": "registro",
        "ingredient": "CASE WHEN length(substancia) < 1000 THEN substancia END", "kind": "nullif(trim(tipo_de_produto), '-')",
        "categories": "array(ds_categoria_produto)"}, stripe_text="tarja", age_text="ds_restricao_uso"),
    "ConsultaRemedios": Feed("ConsultaRemedios", ["coalesce(ean_apresentacao, especificacoes['Código de Barras:'])"], {
        "name": "concat_ws(' ', marca, nome_complemento)", "brand": "coalesce(especificacoes['Marca:'], marca)",
        "maker": "especificacoes['Fabricante:']", "ingredient": "especificacoes['Princípio Ativo:']",
        "kind": "nullif(especificacoes['Tipo do Medicamento:'], 'Outros')", "description": "descricao",
        "registration": "especificacoes['Registro no Ministério da Saúde:']",
        "categories": "array_compact(array(coalesce(especificacoes['Categoria do Medicamento:'], especificacoes['Categoria do Produto:'])))"},
        is_medicine="especificacoes['Categoria do Medicamento:'] IS NOT NULL",
        flags={"is_striped": "coalesce(especificacoes['Necessita de Receita:'] <> 'Isento de Prescrição Médica', false)",
               "is_otc": "coalesce(especificacoes['Necessita de Receita:'] = 'Isento de Prescrição Médica', true)"},
        required=("code", "name")),
    "Sara": Feed("Sara", ["ean"], {
        "name": "trim(concat_ws(' ', product_name, drug_unit, drug_quantity))", "brand": "marketing_company", "maker": "manufacturer",
        "ingredient": "active_ingredient", "dosage": "drug_unit", "description": "product_description",
        "kind": "CASE WHEN regulatory_class = 'Novo' THEN 'Medicamento Novo' ELSE regulatory_class END",
        "registration": "anvisa_code"}, stripe_text="stripe", age_text="usage_restrictions", required=("code", "name")),
}


def parse_feed(raw: DataFrame, feed: Feed, order: Sequence[Column] = ()) -> DataFrame:
    """Raw feed rows in the common schema, one row per code (the first in `order`, then by name)."""
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    out = raw.withColumn("_codes", F.array_compact(F.array(*[F.expr(c) for c in feed.codes])))
    exprs = {c: F.expr(e) for c, e in feed.columns.items()}
    if "kind" in exprs:
        exprs["kind"] = F.coalesce(kinds[exprs["kind"]], exprs["kind"])
    medicine = F.expr(feed.is_medicine).cast("boolean")
    exprs["is_medicine"] = medicine
    if feed.stripe_text:
        s = stripe(F.expr(feed.stripe_text))
        exprs |= {
            "stripe": s, "is_striped": F.coalesce(s != NO_STRIPE, F.lit(False)), "is_otc": s == NO_STRIPE,
            "is_controlled": F.coalesce(s.isin(BLACK, RED_RESTRICTED), F.lit(False))}
    if feed.age_text:
        exprs["age_group"] = age_group(F.expr(feed.age_text))
    exprs |= {c: F.expr(e).cast("boolean") for c, e in feed.flags.items()}
    alternatives = F.expr(feed.alternatives) if feed.alternatives else F.array().cast("array<string>")
    types = {"categories": "array<string>", **{c: "boolean" for c in COMMON if c.startswith("is_")}}
    wide = out.select(
        F.explode("_codes").alias("code"), "_codes", F.coalesce(alternatives, F.array().cast("array<string>")).alias("_more"),
        *[(exprs[c] if c in exprs else F.lit(None)).cast(types.get(c, "string")).alias(c)
          for c in COMMON if c not in ("code", "alternatives", "source")],
        *[o.alias(f"_o{i}") for i, o in enumerate(order)])
    rows = wide.withColumn(
        "alternatives", F.array_distinct(F.concat(F.array_except("_codes", F.array("code")), "_more"))
    ).withColumn("source", F.lit(feed.source)).filter(F.trim("code") != "")
    for c in feed.required:
        rows = rows.filter(F.col(c).isNotNull() & (F.trim(c) != ""))
    return latest(rows, ["code"], [*[F.col(f"_o{i}") for i in range(len(order))], F.col("name")]).select(*COMMON)
