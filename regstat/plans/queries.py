"""Registered queries: one per SURVEY §2 operator (or a small group of them).

Each takes ``(spark, sf_dir)``, reads the driver's tables (the raw register
layouts are derived from them by Spark, see ``sources.fixtures``) and
returns a DataFrame whose column names match its DuckDB oracle in
``regstat.oracle``.  Queries that exercise a sink or a source write to a
fresh folder under the session's shared checkpoint directory and read back.
Comparison views cast money to double and dates to text so both engines
hand over the same Python values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims, schemas
from ..functions import columns as C
from ..operators import classify, cleanse, profile, shape, vintage
from ..session import FREED, scratch_path, settings
from ..sources import fixtures as fx
from ..sources import readers, sinks, versions
from ..streaming.incremental import load_new_files
from . import analyses, flows, marts

OWNER = "regstat"
AS_OF = "2024-01-31"
#: Jobs that the links' years are staged in: one year's rows at a time are in shuffle files.
ROUNDS = 8


# --------------------------------------------------------------------------
# shared building blocks
# --------------------------------------------------------------------------
def activity_dim(spark: SparkSession) -> DataFrame:
    return dims.activity_dimension(spark, fx.fixture_codes())


def estab_treated(spark: SparkSession, sf: str) -> DataFrame:
    return flows.standardize_estab(fx.raw_estab_layouts(spark, sf), OWNER, activity_dim(spark),
                                       dims.size_dimension(spark), as_of=AS_OF)


def links_typed(spark: SparkSession, sf: str) -> DataFrame:
    return flows.standardize_links(fx.raw_links(spark, sf), OWNER, as_of=AS_OF)


def gdp_table(spark: SparkSession, sf: str) -> DataFrame:
    return flows.standardize_gdp(fx.raw_gdp_vintages(spark, sf), OWNER, as_of=AS_OF)


def gdp_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The conformed GDP table as the analyses read it: unsorted."""
    return flows.conformed_gdp(fx.raw_gdp_vintages(spark, sf), OWNER, as_of=AS_OF)


#: Text extracts are packed, as the registers publish them; a packed file is read by one task, so its records are bounded.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}


def write_text(df: DataFrame, path: str, encoding: str = "ISO-8859-1", mode: str = "append", partition_by: Iterable[str] = ()) -> None:
    """An extract file set as the registers publish them."""
    with settings(df.sparkSession, FREED):
        (df.write.option("sep", ";").option("header", "true").option("encoding", encoding).options(**PACKED)
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").mode(mode).partitionBy(*partition_by).csv(path))


def comparable(df: DataFrame) -> DataFrame:
    """Money → double, dates → text (same Python values out of both engines)."""
    out = []
    for f in df.schema.fields:
        c = shape.qcol(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(out)


def estab_stacked(spark: SparkSession, sf: str) -> DataFrame:
    """Both header layouts renamed (SRC-03, PRJ-02) and stacked (SET-01)."""
    return shape.stack_vintages([flows.estab_headers(f) for f in fx.raw_estab_layouts(spark, sf)])


ESTAB_RAW_COLUMNS = [n for n, _ in fx.estab_exprs(fx.SPARK)]


# --------------------------------------------------------------------------
# 2.1 sources
# --------------------------------------------------------------------------
def q_src01_read_cp1252(spark, sf):
    """SRC-01 (+SRC-03, PRJ-02): layouts written as single-byte text, read back as cp1252."""
    root = scratch_path(spark, "src01")
    frames = []
    for i, layout in enumerate(fx.raw_estab_layouts(spark, sf)):
        path = f"{root}/layout{i}"
        (layout.write.option("sep", ";").option("header", "true").option("encoding", "ISO-8859-1")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .partitionBy("ano").mode("overwrite").csv(path))
        frames.append(flows.estab_headers(readers.read_raw(spark, path, encoding="cp1252")))
    df = shape.stack_vintages(frames)
    return df.select([F.col(c) for c in ESTAB_RAW_COLUMNS])


def q_src02_read_latin1(spark, sf):
    """SRC-02 (+PRJ-03): links extract written as ISO-8859-1 text, read back, headers normalised."""
    path = scratch_path(spark, "src02")
    write_text(fx.raw_links(spark, sf), path, partition_by=("ano",))
    df = shape.normalize_headers(readers.read_raw(spark, path, encoding="ISO-8859-1"))
    return df.select([F.col(n) for n, _ in fx.links_exprs(fx.SPARK)])


def mixed_vintages(spark, sf, path: str, years: Iterable[int] = range(2014, 2021)) -> None:
    """Every year's links extract with the columns of its own vintage, in an order of its own, all under one folder."""
    raw = fx.raw_links(spark, sf)
    for year in years:
        own = [c for c in raw.columns if c != "ano" and fx.in_vintage(c, year)]
        turn = year % len(own)
        write_text(raw.filter(F.col("ano") == year).select([shape.qcol(c) for c in own[turn:] + own[:turn]]), f"{path}/ano={year}")


def q_src02_mixed_vintages(spark, sf):
    """SRC-02 + PIPE-02 stage 1: seven vintages with seven headers in one path, each file read by its own."""
    path = scratch_path(spark, "vintages")
    mixed_vintages(spark, sf, path)
    raw = readers.read_raw(spark, path, encoding="ISO-8859-1", treat=lambda d: shape.disambiguate(
        shape.normalize_headers(d), {"tipo_estab": ["tipo_estab41", "tipo_estab42"]}))
    return comparable(flows.links_stage1(raw, OWNER, AS_OF).select(*STAGING_VIEW, "tipo_estab41", "tipo_salario", "ind_trab_parcial"))


def q_src03_duplicate_headers(spark, sf):
    """SRC-03: the repeated 'Tipo Estab' header split into code and description."""
    df = shape.normalize_headers(fx.raw_links(spark, sf))
    df = shape.disambiguate(df, {"tipo_estab": ["tipo_estab", "tipo_estab_dsc"]})
    return df.groupBy("ano", "tipo_estab", "tipo_estab_dsc").agg(F.count(F.lit(1)).alias("n_linhas"))


def q_src04_load_vintages(spark, sf):
    """SRC-04 + SET-01: two GDP workbooks and one empty one, treated and stacked by name."""
    frames = fx.raw_gdp_vintages(spark, sf)
    readers_ = [lambda f=f: f for f in frames] + [lambda: frames[0].limit(0)]
    df = readers.load_vintages(spark, readers_, lambda d: flows.treat_gdp(d, OWNER, AS_OF))
    return df.select(*schemas.SCHEMA_GDP.fieldNames())


def dimension_sources(spark, sf) -> dict[str, Callable[[], DataFrame]]:
    t = lambda n: fx.read_table(spark, sf, n)
    pair = lambda df, code, desc: df.select(F.col(code).cast("string").alias("codigo"),
                                            F.concat(F.lit(" "), F.col(desc).cast("string")).alias("descricao"))
    distinct = lambda n, c: t(n).select(c).distinct()
    return {
        "0_capa": lambda: t("region").limit(0),
        "1_regiao": lambda: pair(t("region"), "r_regionkey", "r_name"),
        "2_nacao": lambda: pair(t("nation"), "n_nationkey", "n_name"),
        "3_marca": lambda: pair(distinct("part", "p_brand").withColumn("c", F.regexp_extract("p_brand", r"(\d+)$", 1)),
                                "c", "p_brand"),
        "4_prioridade": lambda: pair(distinct("orders", "o_orderpriority")
                                     .withColumn("c", F.split_part("o_orderpriority", F.lit("-"), F.lit(1))),
                                     "c", "o_orderpriority"),
        "5_segmento": lambda: pair(distinct("customer", "c_mktsegment"), "c_mktsegment", "c_mktsegment"),
        "6_evento": lambda: pair(distinct("events", "event_type"), "event_type", "event_type"),
        "7_notas": lambda: t("region").limit(0),
    }


def dimensions_long(spark, sf) -> DataFrame:
    """SRC-05: every sheet but the first and last, with the audit columns."""
    loaded = readers.load_dimensions(dimension_sources(spark, sf), prefix="tb_rais_estab")
    return shape.stack_vintages([
        flows.build_dimension(df, OWNER, AS_OF).withColumn("tabela", F.lit(name))
        for name, df in loaded.items()
    ]).select("tabela", "codigo", "descricao", "curr_date", "ds_owner")


def q_dimensions_build(spark, sf):
    """PIPE-04 + SNK-07: every dimension loaded in its narrowest types; the types and rows that were written."""
    root = scratch_path(spark, "dims")
    out = None
    for name, df in readers.load_dimensions(dimension_sources(spark, sf), prefix="tb_rais_estab").items():
        typed, types = flows.typed_dimension(df, OWNER, AS_OF)
        sinks.write_dimension(typed, f"{root}/{name}")
        back = versions.read(spark, f"{root}/{name}").agg(F.count(F.lit(1)).alias("n_linhas"))
        rows = back.select(F.lit(name).alias("tabela"), F.explode(F.create_map(*[F.lit(x) for p in types.items() for x in p])).alias("coluna", "tipo"), "n_linhas")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_src05_load_dimensions(spark, sf):
    return dimensions_long(spark, sf)


def _staged_links(spark, sf) -> str:
    path = scratch_path(spark, "staging")
    stage1 = flows.links_stage1(fx.raw_links(spark, sf), OWNER, AS_OF)
    sinks.append_staging(stage1, path, partition_by=("ano", "uf"), salt_buckets=4, options=flows.plain_values(flows.AMOUNTS), rounds=ROUNDS)
    return path


STAGING_VIEW = ["ano", "uf", "municipio", "vl_remun_dezembro_nom", "tempo_emprego", "bairros_fortaleza",
                "ibge_subsetor", "vl_rem_janeiro_cc", "curr_date"]


def q_src06_read_staging(spark, sf):
    """SRC-06 (+SNK-01): staging written, re-read without `_id`, one state."""
    df = readers.read_staging(spark, _staged_links(spark, sf), uf="SP")
    return comparable(df.select(*STAGING_VIEW))


def q_src07_select_files(spark, sf):
    """SRC-07: file-name rules of the two downloads, on names built from `documents`."""
    docs = fx.read_table(spark, sf, "documents").select("doc_id", "source")
    name = (F.when(F.col("doc_id") % 6 == 0, F.lit("RAIS_ESTAB_PUB.7z"))
            .when(F.col("doc_id") % 6 == 1, F.concat(F.lit("ESTB"), F.col("source"), F.lit(".7z")))
            .when(F.col("doc_id") % 6 == 2, F.concat(F.lit("Estb"), F.col("source"), F.lit(".7z")))
            .when(F.col("doc_id") % 6 == 3, F.concat(F.lit("SP"), F.col("source"), F.lit(".7z")))
            .when(F.col("doc_id") % 6 == 4, F.lit("Leia-me.txt"))
            .otherwise(F.concat(F.col("source"), F.lit("_Legado.7z"))))
    df = docs.select("doc_id", name.alias("arquivo"))
    return df.select(
        "doc_id", "arquivo",
        readers.select_files("arquivo", include_equals=readers.ESTAB_INCLUDE_EQUALS,
                             include_prefixes=readers.ESTAB_INCLUDE_PREFIXES).alias("estab"),
        readers.select_files("arquivo", exclude_substrings=readers.LINKS_EXCLUDE_SUBSTRINGS).alias("vinculos"),
    )


def q_src08_year_slices(spark, sf):
    """SRC-08 (+FLT-02): the years 2011..2014 of the establishments, one scan."""
    df = readers.in_years(fx.raw_estab_canonical(spark, sf), 2011, 2014)
    return df.groupBy("ano").agg(F.count(F.lit(1)).alias("n_linhas"))


def q_src09_incremental(spark, sf):
    """SRC-09: file stream with availableNow; a re-run adds nothing, new files only their rows."""
    root = scratch_path(spark, "src09")
    inbox, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    canon = fx.raw_estab_canonical(spark, sf)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in canon.columns])

    def drop_files(cond):
        """New extract files land in the inbox (the writer's temporary files are hidden)."""
        batch = canon.filter(cond).select([F.col(c).cast("string") for c in canon.columns])
        (batch.write.option("sep", ";").option("header", "true").option("encoding", "ISO-8859-1")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .mode("append").csv(inbox))

    drop_files(F.col("ano") < 2013)
    load_new_files(spark, inbox, out, ckpt, schema)
    load_new_files(spark, inbox, out, ckpt, schema)          # nothing new: adds 0 rows
    drop_files(F.col("ano") >= 2013)
    load_new_files(spark, inbox, out, ckpt, schema)          # only the new files
    return versions.read(spark, out).select([F.col(c) for c in ESTAB_RAW_COLUMNS if c != "ano"]
                                          + [F.col("ano").cast("int").alias("ano")])


def malformed_orders(spark, sf, path: str) -> None:
    """Orders as text of three fields; one record in 97 lacks its last field, one in 101 has a fourth."""
    key = F.col("o_orderkey")
    line = F.concat_ws(";", key.cast("string"), "o_orderstatus", F.when((key % 97 != 0) | (key % 101 == 0), F.col("o_orderpriority")), F.when(key % 101 == 0, F.lit("x")))
    (fx.read_table(spark, sf, "orders").select(line.alias("chave;situacao;prioridade")).write.option("header", "true").option("sep", "\u0001").csv(path))


def q_src01_malformed(spark, sf):
    """SRC-01: records with a field too few or too many are marked with their text and file, the others are read as ever."""
    path = scratch_path(spark, "malformed")
    malformed_orders(spark, sf, path)
    df = readers.read_raw(spark, path, malformed=True, file_col="arquivo")
    return df.select("chave", "situacao", "prioridade", readers.MALFORMED, F.col("arquivo").startswith("part-").alias("com_arquivo"))


def q_src02_file_headers(spark, sf):
    """SRC-01/02, SRC-07: the headers of a folder of files of many layouts, read by the executors; known files are not opened again."""
    root = scratch_path(spark, "headers")
    mixed_vintages(spark, sf, f"{root}/in")
    readers.file_headers(spark, f"{root}/in/ano=2014", "ISO-8859-1", known=f"{root}/known")
    found = readers.file_headers(spark, f"{root}/in", "ISO-8859-1", known=f"{root}/known")
    return found.select(F.regexp_extract("path", "ano=([0-9]{4})", 1).cast("int").alias("ano"), F.size(F.split("header", ";")).alias("n_colunas")).distinct()


def q_src09_stream_mixed(spark, sf):
    """SRC-09 + PIPE-02: files of seven layouts dropped into one inbox in two goes, streamed into the typed table; a third run finds nothing."""
    root = scratch_path(spark, "stream")
    for years in (range(2014, 2018), range(2018, 2021), ()):
        mixed_vintages(spark, sf, f"{root}/in", years)
        flows.stream_links(spark, f"{root}/in", f"{root}/staging", f"{root}/table", f"{root}/ckpt", OWNER, AS_OF)
    return comparable(versions.read(spark, f"{root}/table"))


# --------------------------------------------------------------------------
# 2.2 sinks
# --------------------------------------------------------------------------
def q_snk01_append_staging(spark, sf):
    return comparable(readers.read_staging(spark, _staged_links(spark, sf)).select(*STAGING_VIEW))


def q_snk02_append_table(spark, sf):
    """SNK-02: typed establishments written twice by partition overwrite: no duplicates."""
    path = scratch_path(spark, "snk02")
    table = flows.estab_table(estab_treated(spark, sf))
    sinks.append_table(table, path, schemas.SCHEMA_ESTAB_TABLE, partition_by=("ano",))
    sinks.append_table(table, path, schemas.SCHEMA_ESTAB_TABLE, partition_by=("ano",))
    back = spark.read.parquet(path)
    return back.select([F.col(n).cast(schemas.sql_type(f.dataType)).alias(n)
                        for n, f in zip(schemas.SCHEMA_ESTAB_TABLE.fieldNames(), schemas.SCHEMA_ESTAB_TABLE.fields)])


def q_snk03_replace_table(spark, sf):
    path = scratch_path(spark, "snk03")
    gdp = gdp_table(spark, sf)
    sinks.replace_table(gdp, path)
    n = sinks.replace_table(gdp, path)
    return versions.read(spark, path).agg(F.count(F.lit(1)).alias("n_linhas"), F.lit(n).cast("bigint").alias("n_lido"))


def q_snk03_replace_from_itself(spark, sf):
    """SNK-03: a table replaced from its own rows."""
    path = scratch_path(spark, "snk03_itself")
    sinks.replace_table(gdp_rows(spark, sf), path)
    sinks.replace_table(sinks.read_back(spark, path).filter("ano <> 2010"), path)
    return sinks.read_back(spark, path)


def q_snk04_range_bucket(spark, sf):
    """SNK-04 on the links years 2014..2020 with ranges of 3 from 2010 to 2018."""
    return sinks.flag_range(links_typed(spark, sf), "ano", 2010, 3, 2018).groupBy("ano_de", "ano_ate").agg(F.count(F.lit(1)).alias("n_linhas"))


def q_snk05_validate(spark, sf):
    """SNK-05: state domain and years 2010..2019 → accepted and rejected rows."""
    return sinks.flag_valid(links_typed(spark, sf), years=(2010, 2019)).groupBy("ano", "uf", "aceito").agg(F.count(F.lit(1)).alias("n_linhas"))


def q_snk07_infer_types(spark, sf):
    return profile.infer_narrow_types(estab_treated(spark, sf))


def q_snk07_widening(spark, sf):
    """SNK-07 over several loads: a first sheet of small codes, a second of larger ones, a third whose code is text."""
    path = scratch_path(spark, "widening")
    part = fx.read_table(spark, sf, "part")
    code = F.col("p_partkey")
    sheets = [part.filter("p_partkey % 3 = 0").select((code % 1000).cast("string").alias("codigo"), F.col("p_brand").alias("descricao")),
              part.filter("p_partkey % 3 = 1").select((code + 100000).cast("string").alias("codigo"), F.col("p_type").alias("descricao")),
              part.filter("p_partkey % 3 = 2").select(F.concat(F.lit("P"), code).alias("codigo"), (code + 3000000000).cast("string").alias("descricao"))]
    history = None
    for i, sheet in enumerate(sheets):
        types = flows.load_dimension(sheet, path, OWNER, AS_OF)
        now = versions.read(spark, path).agg(F.count(F.lit(1)).alias("n_linhas"), F.max(F.length(F.col("codigo").cast("string"))).alias("max_len"))
        row = now.select(F.lit(i + 1).alias("carga"), F.lit(types["codigo"]).alias("tipo_codigo"), F.lit(types["descricao"]).alias("tipo_descricao"), "n_linhas", "max_len")
        history = row if history is None else history.unionByName(row)
    return history


def q_snk08_write_dimension(spark, sf):
    path = scratch_path(spark, "snk08")
    sinks.write_dimension(dimensions_long(spark, sf), path)
    return versions.read(spark, path)


# --------------------------------------------------------------------------
# 2.3 projections, 2.4 filters, 2.5 scalar functions
# --------------------------------------------------------------------------
def q_prj01_drop_rename_gdp(spark, sf):
    """PRJ-01 + PRJ-02 on both GDP workbooks (strict drop of 24 columns, 19 renames)."""
    frames = [shape.rename_by_dict(shape.drop_strict(v, fx.GDP_DROP), fx.GDP_HEADERS)
              for v in fx.raw_gdp_vintages(spark, sf)]
    return shape.stack_vintages(frames)


def q_prj02_rename_estab(spark, sf):
    return estab_stacked(spark, sf).select([F.col(c) for c in ESTAB_RAW_COLUMNS])


def q_prj03_normalize_header(spark, sf):
    """PRJ-03 as a column function, on header-like text built from `part`."""
    p = fx.read_table(spark, sf, "part")
    text = F.concat(F.lit(" Vl Remun Média "), F.col("p_name"), F.lit(" (SM)  Ação/"), F.col("p_type"),
                    F.lit("__"), F.col("p_brand"))
    return p.select("p_partkey", text.alias("cabecalho")).select(
        "p_partkey", C.normalize_header("cabecalho").alias("normalizado"))


def q_prj04_audit(spark, sf):
    o = fx.read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    df = shape.with_audit(o, OWNER, ano=F.year("o_orderdate") + 15, as_of=AS_OF, date_as="string")
    return df.drop("o_orderdate")


def q_prj05_harmonize_links(spark, sf):
    """PRJ-05 (+SCL-03, SCL-06, SCL-11, SCL-13): staging rows of all seven vintages."""
    return comparable(flows.links_stage1(fx.raw_links(spark, sf), OWNER, AS_OF))


def q_prj06_harmonize_estab(spark, sf):
    df = vintage.harmonize_estab(estab_stacked(spark, sf), "ano")
    return df.select("ano", "id_municipio", "cnae_2_subclasse", "tipo_estab", "cep", "subsetor_ibge")


def q_flt01_by_uf(spark, sf):
    return comparable(flows.standardize_links(fx.raw_links(spark, sf), OWNER, AS_OF, uf="SP")
                      .select("ano", "uf", "municipio", "vl_remun_dezembro_nom", "vinculo_ativo_31_12"))


def q_flt02_valid_year(spark, sf):
    o = fx.read_table(spark, sf, "orders")
    y = (F.year("o_orderdate") + 15).cast("string")
    k = F.col("o_orderkey") % 5
    text = (F.when(k == 1, F.substring(y, 1, 3)).when(k == 2, F.concat(y, F.lit("5")))
            .when(k == 3, F.lit("abcd")).when(k == 4, F.concat(F.lit("19"), F.substring(y, 3, 2))).otherwise(y))
    return o.select("o_orderkey", text.alias("ano_texto")).select(
        "o_orderkey", "ano_texto", C.valid_year("ano_texto").alias("valido"))


def _estab_decoded(spark, sf) -> DataFrame:
    df = cleanse.decode_sentinels(cleanse.trim_strings(estab_stacked(spark, sf)))
    return cleanse.null_to_unknown(df, ["cnae_2_subclasse", "nat_jur", "tam_estab"]).withColumn(
        "cnae_2_subclasse", C.pad_cnae("cnae_2_subclasse"))


def q_flt03_enterprise_flag(spark, sf):
    df = _estab_decoded(spark, sf)
    return df.groupBy(C.cnae_division("cnae_2_subclasse").alias("divisao"), "nat_jur",
                      classify.enterprise_flag_col().alias("padrao_sebrae"),
                      classify.enterprise_flag_col(strict=True).alias("padrao_sebrae_estrito")).agg(
        F.count(F.lit(1)).alias("n_linhas"))


def q_flt04_is_unknown(spark, sf):
    df = estab_treated(spark, sf)
    return df.groupBy("ano").agg(*[F.sum(F.when(C.is_unknown(c), 1).otherwise(0)).cast("bigint").alias(f"n_{c}")
                                   for c in ["cnae_2_subclasse", "nat_jur", "tam_estab", "id_municipio"]])


def q_scl_codes(spark, sf):
    """SCL-01, -02, -04, -11..-18 on the raw establishment columns."""
    raw = fx.raw_estab_canonical(spark, sf)
    cn = C.strip_ws("cnae_2_subclasse")
    return raw.select(
        "ano", "id_municipio",
        C.strip_ws("cnae_2_classe").alias("classe_limpa"),
        C.sentinel_to_unknown(cn).alias("cnae_decod"),
        C.pad_cnae(cn).alias("cnae_pad"),
        C.cnae_division(C.pad_cnae(cn)).alias("divisao"),
        C.cnae_division(C.pad_cnae(cn), strict=True).alias("divisao_estrita"),
        C.int_text("tam_estab").alias("tam_texto"),
        C.null_to_unknown_col("tam_estab").alias("tam_nulo"),
        C.concat_key(F.col("sigla_uf"), F.col("tam_estab")).alias("chave"),
        C.uf_code_text("id_municipio").alias("uf_texto"),
        C.uf_code_int("id_municipio").alias("uf_numero"),
        C.uf_sigla(C.uf_code_text("id_municipio")).alias("uf_sigla"),
        C.null_to_ni(F.when(F.col("ano") == 2013, F.lit(None)).otherwise(C.uf_sigla(C.uf_code_text("id_municipio"))))
        .alias("uf_ni"),
        C.load_date(AS_OF, "string").alias("curr_date"),
    )


def q_scl_values(spark, sf):
    """SCL-03, -06, -07, -08, -09, -10 on the raw links columns."""
    raw = fx.raw_links_canonical(spark, sf)
    return comparable(raw.select(
        "ano", "municipio",
        C.translate_sentinel("bairros_rj", "{ñ c").alias("bairro_c"),
        C.translate_sentinel("bairros_rj", "{ñ class}").alias("bairro_class"),
        C.translate_sentinel("nacionalidade", "{ñ").alias("nacionalidade"),
        C.comma_to_double("vl_remun_media_nom").alias("media_nom"),
        C.to_money(C.comma_to_dot("vl_remun_dezembro_nom")).alias("dezembro_nom"),
        C.tenure_months(C.comma_to_dot("tempo_emprego")).alias("tempo_emprego"),
        F.col("qtd_dias_afastamento").try_cast("smallint").alias("dias_afastamento"),
        F.col("idade").try_cast("int").alias("idade"),
    ))


# --------------------------------------------------------------------------
# 2.6 lookups
# --------------------------------------------------------------------------
def q_lkp01_02_sectors(spark, sf):
    df = classify.add_sectors(_estab_decoded(spark, sf), activity_dim(spark))
    return df.groupBy("cnae_2_subclasse", "setor_ibge", "setor_sebrae").agg(F.count(F.lit(1)).alias("n_linhas"))


def q_lkp03_porte(spark, sf):
    return estab_treated(spark, sf).groupBy("setor_ibge", "tam_estab", "porte_sebrae").agg(
        F.count(F.lit(1)).alias("n_linhas"))


def q_lkp04_star_join(spark, sf):
    fact = estab_treated(spark, sf).withColumnRenamed("sigla_uf", "codigo_uf")
    sectors = dims.activity_dimension(spark, fx.fixture_codes()).select(
        F.col("setor_ibge"), F.col("setor_sebrae").alias("setor_sebrae_dim")).distinct()
    df = classify.star_join(fact, {"codigo_uf": dims.uf_dimension(spark), "setor_ibge": sectors})
    return df.groupBy("ano", "uf", "setor_sebrae_dim").agg(F.count(F.lit(1)).alias("n_linhas"),
                                                          F.sum("qtd_vinc_ativos").cast("bigint").alias("estoque"))


def q_lkp04_orphans(spark, sf):
    return classify.orphans(_estab_decoded(spark, sf), activity_dim(spark), "cnae_2_subclasse")


# --------------------------------------------------------------------------
# 2.7 aggregations
# --------------------------------------------------------------------------
def q_agg01_n_rows(spark, sf):
    return profile.n_rows(estab_treated(spark, sf))


def q_agg02_total(spark, sf):
    return profile.total(estab_treated(spark, sf), "qtd_vinc_ativos").select(
        F.col("total_qtd_vinc_ativos").cast("bigint").alias("total_qtd_vinc_ativos"))


def q_agg03_by_uf(spark, sf):
    return profile.by_uf_summary(estab_treated(spark, sf)).select(
        "sigla_uf", F.col("soma_vinc_ativos").cast("bigint").alias("soma_vinc_ativos"), "n_municipio")


def q_agg04_null_profile(spark, sf):
    return profile.null_profile(fx.raw_estab_canonical(spark, sf))


def q_agg05_sentinel_profile(spark, sf):
    return profile.sentinel_profile(estab_treated(spark, sf))


def q_agg06_column_profile(spark, sf):
    return profile.column_profile(estab_treated(spark, sf),
                                  ["sigla_uf", "nat_jur", "cnae_2_subclasse", "setor_ibge", "porte_sebrae", "cep"])


def _load_estab(spark, sf, path: str, keep=None, **kw) -> None:
    layouts = [f if keep is None else f.filter(keep) for f in fx.raw_estab_layouts(spark, sf)]
    flows.load_estab(layouts, OWNER, activity_dim(spark), dims.size_dimension(spark), path, AS_OF, **kw)


def q_agg05_load_report(spark, sf):
    """AGG-01..05 as the load's own report: collected in the tasks that write the table."""
    path = scratch_path(spark, "report")
    _load_estab(spark, sf, path)
    return profile.load_report(spark, path)


PROFILED = ["sigla_uf", "nat_jur", "cnae_2_subclasse", "setor_ibge", "porte_sebrae", "cep"]


def q_agg06_profile_by_year(spark, sf):
    """AGG-06 kept up to date: the profile of a table after its first years, then after the rest, which alone is read."""
    root = scratch_path(spark, "profile")
    for keep in ("ano <= 2012", "ano > 2012"):
        _load_estab(spark, sf, f"{root}/table", keep)
        out = profile.refresh_profile(spark, f"{root}/table", f"{root}/state", PROFILED)
    return out


# --------------------------------------------------------------------------
# 2.8 analyses, 2.10 sorts, 2.14 composed flows
# --------------------------------------------------------------------------
def q_qry01_headcount(spark, sf):
    return analyses.headcount(links_typed(spark, sf))


def q_qry02_headcount_by_size(spark, sf):
    return analyses.headcount_by_size(links_typed(spark, sf))


def q_qry03_mean_pay(spark, sf):
    return analyses.mean_pay(links_typed(spark, sf))


def q_qry04_estab_breakdown(spark, sf):
    return analyses.estab_breakdown(estab_treated(spark, sf))


def q_qry05_gdp_growth(spark, sf):
    return analyses.gdp_growth(gdp_rows(spark, sf))


def q_qry05_gdp_growth_gap(spark, sf):
    """QRY-05 on a series that lacks 2010: no growth is reported for 2011."""
    return analyses.gdp_growth(gdp_rows(spark, sf).filter("ano <> 2010"))


def q_qry06_gdp_rank(spark, sf):
    return analyses.gdp_rank(gdp_rows(spark, sf))


def q_qry07_gdp_per_capita(spark, sf):
    """QRY-07: inhabitants per place and year (customers of the nation, growing by the year)."""
    gdp = gdp_rows(spark, sf)
    people = fx.population(spark, sf).select((F.col("n_nationkey") + 11).cast("bigint").alias("codigo_uf"), "n_pop")
    pop = gdp.select("id_municipio", "ano", "codigo_uf").distinct().join(people, "codigo_uf").select(
        "id_municipio", "ano", (F.col("n_pop") + F.col("ano") - 2000).alias("populacao"))
    return analyses.gdp_per_capita(gdp, pop)


def q_srt02_preview(spark, sf):
    return shape.preview(gdp_table(spark, sf), 5, ["ano", "sigla_uf", "id_municipio"]).select(
        "ano", "sigla_uf", "id_municipio", "pib_corrente")


def q_estab_standardize(spark, sf):
    return estab_treated(spark, sf)


def q_estab_load(spark, sf):
    """PIPE-01 with its I/O: range check, year-partitioned idempotent write (run twice), read back."""
    path = scratch_path(spark, "estab_load")
    for _ in range(2):
        flows.load_estab(fx.raw_estab_layouts(spark, sf), OWNER, activity_dim(spark), dims.size_dimension(spark),
                             path, AS_OF)
    back = versions.read(spark, path)
    return back.select([F.col(f.name).cast(schemas.sql_type(f.dataType)).alias(f.name)
                        for f in schemas.SCHEMA_ESTAB_TABLE.fields])


def q_estab_table(spark, sf):
    return flows.estab_table(estab_treated(spark, sf))


def q_links_standardize(spark, sf):
    return comparable(links_typed(spark, sf))


def q_links_load(spark, sf):
    """PIPE-02 with its I/O: staging, re-read, typed, validated, written by (ano, uf), read back."""
    root = scratch_path(spark, "links_load")
    for _ in range(2):                     # a re-run on the same folders replaces, never doubles
        flows.load_links(fx.raw_links(spark, sf), OWNER, f"{root}/staging", f"{root}/table", AS_OF, keep=1, rounds=ROUNDS)
    back = versions.read(spark, f"{root}/table")
    return comparable(back.select([F.col(f.name).cast(schemas.sql_type(f.dataType)).alias(f.name)
                                   for f in schemas.SCHEMA_LINKS.fields]))


def q_set02_two_files_one_year(spark, sf):
    """SET-02: each year in two files loaded one after the other, then one of them again: the whole table."""
    root = scratch_path(spark, "two_files")
    raw = fx.raw_links(spark, sf)
    half = F.pmod(F.coalesce(F.col("Idade").try_cast("int"), F.lit(0)), F.lit(2))
    for name in ("a", "b", "a"):
        flows.load_links(raw.filter(half == ("a", "b").index(name)), OWNER, f"{root}/staging", f"{root}/table", AS_OF, batch=name, keep=1, rounds=ROUNDS)
    back = versions.read(spark, f"{root}/table")
    return comparable(back.select([F.col(f.name).cast(schemas.sql_type(f.dataType)).alias(f.name) for f in schemas.SCHEMA_LINKS.fields]))


def q_set02_corrected_file(spark, sf):
    """SET-02: a file loaded, then its corrected form without one state's rows of one year: none of them stay."""
    root = scratch_path(spark, "corrected")
    raw = fx.raw_links(spark, sf)
    flows.load_links(raw, OWNER, f"{root}/staging", f"{root}/table", AS_OF, batch="a", keep=1, rounds=ROUNDS)
    ro = F.col("Município").startswith("11")
    flows.load_links(raw.filter((F.col("ano") == 2018) & ~F.coalesce(ro, F.lit(False))), OWNER, f"{root}/staging", f"{root}/table", AS_OF, batch="a", keep=1, rounds=ROUNDS)
    return comparable(versions.read(spark, f"{root}/table"))


def q_set02_load_made_up(spark, sf):
    """SET-02: a load that dies between staging and table is made up for by the next one, whichever file it is of."""
    root = scratch_path(spark, "made_up")
    raw = fx.raw_links(spark, sf).withColumn("arquivo", F.concat(F.lit("f"), F.col("ano").cast("string")))
    stage1 = flows.links_stage1(raw.filter("ano <= 2016"), OWNER, AS_OF)
    versions.commit(stage1, f"{root}/staging", ("ano", "arquivo", "uf"), flows.SAME_FILE, options=flows.plain_values(flows.AMOUNTS), rounds=ROUNDS)        # staged, and no more
    flows.load_links(raw.filter("ano > 2016"), OWNER, f"{root}/staging", f"{root}/table", AS_OF, rounds=ROUNDS)
    return comparable(versions.read(spark, f"{root}/table"))


def q_qry01_headcount_mart(spark, sf):
    """QRY-01 from its mart: after a state's reload only its slice is aggregated again."""
    root = scratch_path(spark, "mart01")
    typed = links_typed(spark, sf)
    versions.commit(typed, f"{root}/table", ("ano", "uf"), options=flows.plain_values(flows.AMOUNTS), rounds=ROUNDS)
    marts.refresh(spark, "headcount", f"{root}/table", f"{root}/mart")
    again = typed.filter("ano = 2018 and uf = 'SP' and sexo_trabalhador = 1")
    versions.commit(again, f"{root}/table", ("ano", "uf"), versions.same("ano", "uf"), options=flows.plain_values(flows.AMOUNTS))
    if marts.refresh(spark, "headcount", f"{root}/table", f"{root}/mart") != [{"ano": "2018", "uf": "SP"}]:
        raise AssertionError("more than the reloaded slice was read")
    return marts.result(spark, "headcount", f"{root}/mart")


def q_qry04_breakdown_mart(spark, sf):
    """QRY-04 from its mart, loaded in two goes."""
    root = scratch_path(spark, "mart04")
    for keep in ("ano <= 2013", "ano > 2013"):
        _load_estab(spark, sf, f"{root}/table", keep)
        marts.refresh(spark, "estab_breakdown", f"{root}/table", f"{root}/mart")
    return marts.result(spark, "estab_breakdown", f"{root}/mart")


def q_snk05_place_lookup(spark, sf):
    """SNK-05's index on a place: the links of the smallest municipality code of one state, from the table ordered and filtered by it."""
    root = scratch_path(spark, "lookup")
    flows.load_links(fx.raw_links(spark, sf), OWNER, f"{root}/staging", f"{root}/table", AS_OF, rounds=ROUNDS)
    place = versions.read(spark, f"{root}/table").filter("uf = 'SP'").agg(F.min("municipio")).first()[0]
    return comparable(flows.links_of_place(spark, f"{root}/table", place, "SP"))


def q_estab_two_files(spark, sf):
    """SET-02 on establishments: two files of every year, the first one loaded twice."""
    path = scratch_path(spark, "estab_two")
    for name in ("a", "b", "a"):
        half = lambda f: F.pmod(F.coalesce(shape.qcol("ESTOQUE" if "ESTOQUE" in f.columns else "Qtd Vínculos Ativos").try_cast("int"), F.lit(0)), F.lit(2))
        some = [f.filter(half(f) == ("a", "b").index(name)) for f in fx.raw_estab_layouts(spark, sf)]
        flows.load_estab(some, OWNER, activity_dim(spark), dims.size_dimension(spark), path, AS_OF, batch=name)
    back = versions.read(spark, path)
    return back.select([F.col(f.name).cast(schemas.sql_type(f.dataType)).alias(f.name) for f in schemas.SCHEMA_ESTAB_TABLE.fields])


def q_gdp_load_text(spark, sf):
    """PIPE-03 from text exports with the workbook's line-broken headers."""
    root = scratch_path(spark, "gdp_text")
    vintages = []
    for i, df in enumerate(fx.raw_gdp_vintages(spark, sf)):
        text = df.select([shape.qcol(c).cast("string").alias(c) for c in df.columns])
        write_text(text, f"{root}/in{i}", "UTF-8")
        vintages.append(readers.read_raw(spark, f"{root}/in{i}", encoding="UTF-8", multi_line=True))
    flows.load_gdp(vintages, OWNER, f"{root}/table", AS_OF)
    return versions.read(spark, f"{root}/table").select(*schemas.SCHEMA_GDP.fieldNames())


def q_gdp_standardize(spark, sf):
    return gdp_table(spark, sf)


def q_gdp_load(spark, sf):
    """PIPE-03 with its I/O: full replace of a range-partitioned, sorted table; count read back."""
    path = scratch_path(spark, "gdp_load")
    n = flows.load_gdp(fx.raw_gdp_vintages(spark, sf), OWNER, path, AS_OF)
    return versions.read(spark, path).withColumn("n_lido", F.lit(n).cast("bigint"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
