"""Composed pipelines PIPE-01..04 — each one logical plan, in the reference's step order.

All years (and states) go through one plan: the year is a column taken from
each file, so there is no loop per year or per state, and nothing is
collected to the driver.  The only joins are broadcast lookups of bounded
dimensions, so the fact rows are never shuffled before the write.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import columns as C
from ..operators import cleanse, classify, profile, shape, vintage
from ..session import settings, wide
from ..sources import readers, sinks, versions
from ..sources.readers import MALFORMED

# Establishment columns whose NULL becomes -1 (23).
ESTAB_NULL_TO_UNKNOWN = ["bairro_sp", "bairro_fortaleza", "bairro_rj", "cnae_2_classe", "cnae_1_classe",
                         "distrito_sp", "qtd_vinc_clt", "qtd_vinc_ativos", "qtd_vinc_estat", "ind_ativ_ano",
                         "ind_cei_vinculado", "ind_pat", "ind_rais_negativa", "ind_simples", "id_municipio",
                         "nat_jur", "regiao_adm_df", "cnae_2_subclasse", "tam_estab", "tipo_estab", "sigla_uf",
                         "subsetor_ibge", "cep"]
# Establishment columns cast to integer at the end (24).
ESTAB_INT_COLUMNS = ["bairro_sp", "bairro_fortaleza", "bairro_rj", "cnae_2_classe", "cnae_1_classe", "distrito_sp",
                     "qtd_vinc_clt", "qtd_vinc_ativos", "qtd_vinc_estat", "ind_ativ_ano", "ind_cei_vinculado",
                     "ind_pat", "ind_rais_negativa", "ind_simples", "id_municipio", "nat_jur", "regiao_adm_df",
                     "cnae_2_subclasse", "tam_estab", "tipo_estab", "sigla_uf", "subsetor_ibge", "cep",
                     "padrao_sebrae"]

#: Columns that go along from the reader to staging: the file, and the text of records that do not fit their header.
CARRIED = ("arquivo", MALFORMED)


# --------------------------------------------------------------------------
# PIPE-01 establishments
# --------------------------------------------------------------------------
def estab_headers(df: DataFrame) -> DataFrame:
    """SRC-03 + PRJ-02 for one header layout: repeated 'Tipo Estab' copies, then the dictionary."""
    df = shape.disambiguate(df, {"Tipo Estab": ["tipo_estab", "ctg_tipo_estab"]})
    return shape.rename_by_dict(df, schemas.ESTAB_HEADERS)


def estab_sources(layout: DataFrame) -> dict[str, str]:
    """Target name → raw header of one layout (SRC-03, PRJ-02), without a projection of its own."""
    copies = shape.disambiguation_map(layout.columns, {"Tipo Estab": ["tipo_estab", "ctg_tipo_estab"]})
    names = shape.renamed([copies.get(c, c) for c in layout.columns], schemas.ESTAB_HEADERS)
    return dict(zip(names, layout.columns))


def standardize_estab(layouts: Sequence[DataFrame] | DataFrame, owner: str, activity_dim: DataFrame,
                      size_dim: DataFrame, as_of: str | None = None, strict_division: bool = False) -> DataFrame:
    """Raw establishment extracts (one frame per header layout, each with the
    file's year ``ano``) → the 30 treated columns, in output order.

    The per-column steps are composed into a few projections (the analyser
    cost grows with every DataFrame call, the executed plan does not; and plain
    renames of columns that a filter below reads would double the optimizer's inferred
    constraints with each name, so names change together with values), in the
    reference's order: state number from the raw municipality, vintage rule,
    trim, sentinels, NULL → -1, code padding, flag, size text, lookups, casts.
    """
    if isinstance(layouts, DataFrame):
        layouts = [layouts]
    text = [c for c in ESTAB_NULL_TO_UNKNOWN if c != "sigla_uf"]

    def decoded(layout: DataFrame) -> DataFrame:
        source = estab_sources(layout)                                                # SRC-03, PRJ-02
        schemas.require(text, source, schemas.ESTAB_MAY_LACK)
        raw = {c: shape.qcol(source[c]) if c in source else F.lit(None).cast("string") for c in text}
        raw.update(vintage.estab_fixed(raw, F.col("ano")))                            # PRJ-06
        return layout.select(
            F.col("ano"), *[c for c in CARRIED if c in layout.columns],
            C.load_date(as_of, "string").alias("curr_date"), F.lit(owner).alias("ds_owner"),  # PRJ-04
            F.coalesce(C.uf_code_int(raw["id_municipio"]), F.lit(-1)).alias("sigla_uf"),       # SCL-12 (raw text)
            *[C.null_to_unknown_col(C.sentinel_to_unknown(C.strip_ws(raw[c]), C.SENTINELS)).alias(c) for c in text],   # SCL-01, SCL-02, SCL-04
        )

    df = shape.stack_vintages([decoded(f) for f in layouts])                          # SET-01
    df = df.withColumn("cnae_2_subclasse", C.pad_cnae("cnae_2_subclasse"))            # SCL-14
    df = df.withColumns({
        "padrao_sebrae": classify.enterprise_flag_col(strict=strict_division),         # SCL-15, FLT-03
        "tam_estab": C.int_text("tam_estab"),                                          # SCL-16
    })
    df = classify.add_sectors(df, activity_dim)                                        # LKP-01, LKP-02
    df = classify.add_porte(df, size_dim)                                              # SCL-17, LKP-03
    df = cleanse.cast_ints(df, ESTAB_INT_COLUMNS)                                      # SCL-09
    df = cleanse.fill_unknown(cleanse.trim_strings(df, skip=CARRIED), skip=("ano", *CARRIED))   # SCL-01, SCL-04
    return shape.select_ordered(df, schemas.ESTAB_OUTPUT_ORDER + [c for c in CARRIED if c in df.columns])   # PRJ-07


def estab_table(df: DataFrame) -> DataFrame:
    """Treated establishments conformed to the warehouse schema (SNK-06)."""
    return cleanse.conform(df, schemas.SCHEMA_ESTAB_TABLE)


def stage_estab(treated: DataFrame, batch: str) -> DataFrame:
    """Table rows with the file they came from (``arquivo``; the batch's name for rows without one), and what did not fit its header."""
    named = treated if "arquivo" in treated.columns else treated.withColumn("arquivo", F.lit(batch))
    carried = [T.StructField(c, T.StringType()) for c in CARRIED if c in named.columns]
    return cleanse.conform(named, T.StructType([*schemas.SCHEMA_ESTAB_TABLE.fields, *carried]))


# --------------------------------------------------------------------------
# PIPE-02 employment links
# --------------------------------------------------------------------------
def links_stage1(raw: DataFrame, owner: str, as_of: str | None = None) -> DataFrame:
    """Raw text (any mix of vintages, ``ano`` per row) → staging rows, one projection:
    normalised names (PRJ-03), state letters (SCL-11, SCL-13), the vintage rule
    table (PRJ-05) and the audit columns (PRJ-04)."""
    named = shape.normalize_headers(raw)
    uf = C.uf_sigla(C.uf_code_text("municipio"))
    df = vintage.harmonize_links(named.withColumn("uf", uf), "ano")
    return wide(shape.with_audit(df, owner, ano=F.col("ano"), as_of=as_of, date_as="date"))


def links_stage2(staging: DataFrame, uf: str | None = None) -> DataFrame:
    """Staging rows → the 65-column typed table (optionally one state), one projection."""
    df = staging.drop("_id") if "_id" in staging.columns else staging
    if uf is not None:
        df = shape.by_uf(df, uf)                                                       # FLT-01 after SCL-05
    copies = shape.disambiguation_map(df.columns, {"tipo_estab": ["tipo_estab", "tipo_estab_dsc"]})
    source = {copies.get(c, c): c for c in df.columns}                                # SRC-03 (target → source)
    schemas.require(schemas.SCHEMA_LINKS.fieldNames(), source, schemas.LINKS_MAY_LACK)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schemas.SCHEMA_LINKS.fields:                                              # SCL-10
        src = source.get(f.name)
        if src is None:
            col = F.lit(None)
        elif f.name == "uf":
            col = C.null_to_ni(shape.qcol(src))                                        # SCL-05
        elif isinstance(types[src], T.StringType):
            col = C.sentinel_to_unknown(shape.qcol(src), C.SENTINELS_LINKS)            # SCL-02
        else:
            col = shape.qcol(src)
        if f.name == "tempo_emprego":
            col = C.tenure_months(col)                                                 # SCL-08
        out.append(col.try_cast(schemas.sql_type(f.dataType)).alias(f.name))
    return wide(df.select(out))


def standardize_links(raw: DataFrame, owner: str, as_of: str | None = None, uf: str | None = None) -> DataFrame:
    return links_stage2(links_stage1(raw, owner, as_of), uf)


# --------------------------------------------------------------------------
# PIPE-03 municipal GDP
# --------------------------------------------------------------------------
def treat_gdp(df: DataFrame, owner: str, as_of: str | None = None) -> DataFrame:
    df = shape.drop_strict(df, schemas.GDP_DROP)                                      # PRJ-01
    df = shape.rename_by_dict(df, schemas.GDP_HEADERS, case_sensitive=True)           # PRJ-02 (pandas rename)
    df = shape.with_audit(df, owner, as_of=as_of, date_as="string")                    # PRJ-04
    return cleanse.trim_strings(df)                                                    # SCL-01


def conformed_gdp(vintages: Sequence[DataFrame], owner: str, as_of: str | None = None) -> DataFrame:
    """The stacked workbooks in the table's schema, unsorted: what the analyses read."""
    stacked = shape.stack_vintages([treat_gdp(v, owner, as_of) for v in vintages])   # SET-01
    return cleanse.conform(stacked, schemas.SCHEMA_GDP, schemas.GDP_MAY_LACK)         # SNK-06


def standardize_gdp(vintages: Sequence[DataFrame], owner: str, as_of: str | None = None) -> DataFrame:
    return shape.sort_gdp(conformed_gdp(vintages, owner, as_of))                      # SRT-01


# --------------------------------------------------------------------------
# PIPE-04 dimensions
# --------------------------------------------------------------------------
def build_dimension(df: DataFrame, owner: str, as_of: str | None = None) -> DataFrame:
    """The sheet's text, trimmed, with the audit columns."""
    return cleanse.trim_strings(shape.with_audit(df, owner, as_of=as_of, date_as="string"))


def typed_dimension(df: DataFrame, owner: str, as_of: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """PIPE-04: the dimension in its narrowest types (SNK-07), and the type of each column.

    Text whose every value is an integer counts as an integer; other text keeps its length as ``varchar(n)``.
    """
    dim = build_dimension(df, owner, as_of)
    typed = profile.integers_of_text(dim)
    types = {r["coluna"]: r["tipo"] for r in profile.infer_narrow_types(typed, use_min=True).collect()}     # one row a column
    return typed.select([shape.qcol(c) if types[c].startswith("varchar") else shape.qcol(c).cast(types[c]).alias(c) for c in typed.columns]), types


#: Integer types of a dimension, narrow to wide, and the longest text of each.
INTEGERS = {"smallint": 6, "int": 11, "bigint": 20}


def wider_type(a: str | None, b: str | None) -> str:
    """The narrowest dictionary type that holds the values of both."""
    if a is None or b is None:
        return a or b
    order = list(INTEGERS)
    if a in INTEGERS and b in INTEGERS:
        return max(a, b, key=order.index)
    length = lambda t: INTEGERS[t] if t in INTEGERS else int(t[8:-1])
    return f"varchar({max(length(a), length(b))})"


def load_dimension(df: DataFrame, path: str, owner: str, as_of: str | None = None) -> dict[str, str]:
    """PIPE-04 with its I/O: a dictionary sheet's rows are added to their table, whose column types widen when they have to.

    The registry of types (SNK-07, from all loads so far) is kept with each version.
    Integers widen in place: stored files stay and are read as the wider type.  A column that turns
    from integer to text has the stored rows written again, in the same commit.  Returns the registry.
    """
    typed, found = typed_dimension(df, owner, as_of)
    spark, base = df.sparkSession, versions.latest(df.sparkSession, path)
    known = base.notes.get("types", {}) if base else {}
    types = {c: wider_type(known.get(c), found.get(c)) for c in {**known, **found}}
    as_type = lambda frame: frame.select([shape.qcol(c).cast("string" if types[c].startswith("varchar") else types[c]).alias(c) for c in frame.columns])
    turned = any(known.get(c) in INTEGERS and types[c] not in INTEGERS for c in types)
    if turned:
        versions.commit(shape.stack_vintages([as_type(versions.read(spark, path)), as_type(typed)]), path, replaces=versions.everything, notes={"types": types}, retype=True)
    else:
        versions.commit(as_type(typed), path, replaces=versions.nothing, notes={"types": types})
    return types


# --------------------------------------------------------------------------
# The pipelines with their I/O (staging, validation, partitioned warehouse)
# --------------------------------------------------------------------------
#: Planning a load: constraints inferred from a filter over many raw columns would double with every renamed column.
PLANNING = {"spark.sql.constraintPropagation.enabled": "false"}
#: The links table's lookup column inside (ano, uf): rows of a file are in its order, and its row groups carry a Bloom filter.
LOOKUP = ("municipio",)
#: Amounts of the links, hardly ever the same twice.
AMOUNTS = (*vintage.PAY_COLUMNS, *(f"vl_rem_{m}_cc" for m in vintage.MONTHS), "vl_salario_contratual")
#: Staging slices a table slice: up to so many are written where they are read, more are brought together by a shuffle.
FEW = 4
#: Slices of a file: a load replaces all of them, also those that the file no longer has.
SAME_FILE = versions.same("ano", "arquivo")


def read_links(spark: SparkSession, path: str | Sequence[str], encoding: str = "ISO-8859-1", sep: str = ";", year_from_name: str | None = None, known_headers: str | None = None) -> DataFrame:
    """Links extracts ready for :func:`load_links`: each file by its own header, checked against the columns of its own
    years, with its name and the records that do not fit."""
    def named(df: DataFrame) -> DataFrame:
        return shape.disambiguate(shape.normalize_headers(df), {"tipo_estab": ["tipo_estab41", "tipo_estab42"]})

    return readers.read_raw(spark, path, encoding, sep, year_from_name=year_from_name, file_col="arquivo", treat=named, malformed=True,
                            known_headers=known_headers, check=vintage.check_links)


def read_estab(spark: SparkSession, path: str | Sequence[str], encoding: str = "cp1252", sep: str = ";", year_from_name: str | None = None, known_headers: str | None = None) -> DataFrame:
    """Establishment extracts ready for :func:`load_estab`, as :func:`read_links`."""
    return readers.read_raw(spark, path, encoding, sep, year_from_name=year_from_name, file_col="arquivo", treat=estab_headers, malformed=True,
                            known_headers=known_headers, check=vintage.check_estab)


def bloom_filters(columns: Iterable[str], values: int = 10_000) -> dict[str, str]:
    """Parquet writer options: a Bloom filter in each row group for columns of at most about ``values`` different values in it."""
    return {k: v for c in columns for k, v in ((f"parquet.bloom.filter.enabled#{c}", "true"), (f"parquet.bloom.filter.expected.ndv#{c}", str(values)))}


def plain_values(columns: Iterable[str]) -> dict[str, str]:
    """Parquet writer options: columns of mostly different values are written as they are; a dictionary of them would be filled for nothing."""
    return {f"parquet.enable.dictionary#{c}": "false" for c in columns}


def links_of_place(spark: SparkSession, table_path: str, municipio: int, uf: str | None = None) -> DataFrame:
    """All links of one municipality: one state's slices if it is named, and in them the row groups that can hold it."""
    rows = versions.read(spark, table_path).filter(F.col("municipio") == municipio)
    return rows.filter(F.col("uf") == uf) if uf else rows


def _refresh(spark: SparkSession, staging: str, table: str) -> tuple[versions.Version, list[int]]:
    """Staging's newest version, and the years in which it differs from the version the table was built from."""
    now, built = versions.latest(spark, staging), versions.latest(spark, table)
    since = built.notes.get("staging") if built else None
    old = versions.latest(spark, staging, since) if since else None
    return now, sorted({int(s["ano"]) for s in versions.changed(old, now) if s["ano"] is not None})


def _quarantine(spark: SparkSession, staging: str, now: versions.Version, years: Iterable[int], path: str | None) -> None:
    """Records that do not fit their header, by year and file; a corrected file's old ones go."""
    if path and MALFORMED in now.schema.fieldNames():
        bad = versions.rows(spark, staging, now).filter(F.col("ano").isin(list(years)) & F.col(MALFORMED).isNotNull())
        versions.commit(bad.select("ano", "arquivo", MALFORMED), path, ("ano", "arquivo"), versions.where(lambda s: int(s["ano"]) in set(years)))


def _fitting(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col(MALFORMED).isNull()).drop(MALFORMED) if MALFORMED in staged.columns else staged


def load_links(raw: DataFrame, owner: str, staging_path: str, table_path: str, as_of: str | None = None,
               years: tuple[int, int] | None = None, salt_buckets: int | None = None, batch: str = "lote",
               quarantine_path: str | None = None, transaction: tuple[str, int] | None = None, keep: int | None = None,
               rounds: int | None = None) -> DataFrame:
    """PIPE-02 end to end: raw → staging (SNK-01) → re-read (SRC-06) → typed
    (stage 2) → checked (SNK-05) → warehouse partitioned by (ano, uf) (SNK-02).

    Staging and table are versioned (:mod:`regstat.sources.versions`).  Staging keeps each
    file's rows apart (``ano``, ``arquivo``, ``uf``): a load replaces all slices of its own files,
    so a second file of a year adds to it, a re-run of one changes nothing, and a
    corrected file leaves no old rows.  ``arquivo`` comes from the reader
    (:func:`read_links`); rows without it belong to ``batch``.  Every year in which staging
    differs from what the table was built from is then typed again and replaced as a
    whole; a load that died in between is made up for by the next one.  Raw text is
    read once.  Records that do not fit their header stay in staging, out of the table, and
    go to ``quarantine_path`` if given.  Writers adapt to the size of each slice; ``salt_buckets``
    fixes their number instead.  ``keep`` deletes what none of the newest ``keep`` versions of staging
    and table holds as soon as it is replaced (:func:`versions.vacuum`); by default all versions
    stay.  ``rounds`` stages the years in so many jobs, so that the shuffle files of one job lie on disk at a time
    (:func:`sinks.write_partitioned`).  Returns the rejected rows, read from staging.
    """
    stage1 = links_stage1(raw, owner, as_of)
    if "arquivo" not in stage1.columns:
        stage1 = stage1.withColumn("arquivo", F.lit(batch))
    with settings(raw.sparkSession, PLANNING):
        versions.commit(stage1, staging_path, ("ano", "arquivo", "uf"), SAME_FILE, salt_buckets=salt_buckets, transaction=transaction,
                        options=plain_values(AMOUNTS), rounds=rounds)
    if keep:
        versions.vacuum(raw.sparkSession, staging_path, keep)
    rejected = rebuild_links(raw.sparkSession, staging_path, table_path, years, salt_buckets, quarantine_path)
    if keep:
        versions.vacuum(raw.sparkSession, table_path, keep)
    return rejected


def _gathered(now: versions.Version, years: Iterable[int]) -> bool:
    """Whether staging holds the rows of each (ano, uf) in few slices, by its manifest."""
    mine = [(s, len(loads)) for s, loads in ((versions.slice_values(n), l) for n, l in now.slices.items()) if s["ano"] is not None and int(s["ano"]) in set(years)]
    return sum(n for _, n in mine) <= FEW * len({(s["ano"], s["uf"]) for s, _ in mine})


def rebuild_links(spark: SparkSession, staging_path: str, table_path: str, years: tuple[int, int] | None = None,
                  salt_buckets: int | None = None, quarantine_path: str | None = None) -> DataFrame:
    """The second half of :func:`load_links`: bring the table up to its staging; returns the rejected rows of the years it touched.

    Staging's slices are parts of the table's, so its rows are shuffled again only where a table slice has many of them.
    """
    now, touched = _refresh(spark, staging_path, table_path)
    staged = versions.rows(spark, staging_path, now).filter(F.col("ano").isin(touched)).drop("arquivo")
    ok, rejected = sinks.validate_and_partition(links_stage2(_fitting(staged)), years=years)
    if touched:
        _quarantine(spark, staging_path, now, touched, quarantine_path)
        sinks.check_schema(ok, schemas.SCHEMA_LINKS)
        versions.commit(ok, table_path, ("ano", "uf"), versions.where(lambda s: s["ano"] is not None and int(s["ano"]) in touched),
                        notes={"staging": now.number}, salt_buckets=salt_buckets, metrics=profile.load_metrics(ok, total="vinculo_ativo_31_12", state="uf"),
                        sort_by=LOOKUP, options={**bloom_filters(LOOKUP), **plain_values(AMOUNTS)}, gathered=_gathered(now, touched))
    return rejected


def load_estab(layouts: Sequence[DataFrame] | DataFrame, owner: str, activity_dim: DataFrame, size_dim: DataFrame,
               table_path: str, as_of: str | None = None, first_year: int = 2010, range_years: int = 3,
               last_year: int = 2027, salt_buckets: int | None = None, staging_path: str | None = None,
               batch: str = "lote", quarantine_path: str | None = None, transaction: tuple[str, int] | None = None) -> DataFrame:
    """PIPE-01 end to end: treated rows conformed to the table (SNK-06), staged by
    (``ano``, ``arquivo``) next to the table, checked against the table's 3-year ranges
    (SNK-04) and written by year (SNK-02).  Files, years and misfits are kept as in
    :func:`load_links`.  Returns the rows outside every range, read from staging."""
    staging = staging_path or table_path.rstrip("/") + "_staging"
    treated = standardize_estab(layouts, owner, activity_dim, size_dim, as_of)
    spark = treated.sparkSession
    with settings(spark, PLANNING):
        versions.commit(stage_estab(treated, batch), staging, ("ano", "arquivo"), SAME_FILE, salt_buckets=salt_buckets, transaction=transaction)
    now, touched = _refresh(spark, staging, table_path)
    table = cleanse.conform(_fitting(versions.rows(spark, staging, now).filter(F.col("ano").isin(touched))), schemas.SCHEMA_ESTAB_TABLE)
    inside, outside = sinks.range_bucket(table, "ano", first_year, range_years, last_year)
    if touched:
        _quarantine(spark, staging, now, touched, quarantine_path)
        ok = inside.select(*schemas.SCHEMA_ESTAB_TABLE.fieldNames())
        versions.commit(ok, table_path, ("ano",), versions.where(lambda s: s["ano"] is not None and int(s["ano"]) in touched),
                        notes={"staging": now.number}, salt_buckets=salt_buckets, metrics=profile.load_metrics(ok, total="qtd_vinc_ativos", state="sigla_uf"))
    return outside


def load_gdp(vintages: Sequence[DataFrame], owner: str, table_path: str, as_of: str | None = None,
             partitions: int | None = None) -> int:
    """PIPE-03 end to end: the whole table is replaced (SNK-03), written in
    (ano, sigla_uf, id_municipio) order by range partitions sorted inside
    (SRT-01 without a single-task global sort); returns the rows read back."""
    gdp = conformed_gdp(vintages, owner, as_of)
    ordered = shape.sorted_for_write(gdp, ["ano", "sigla_uf", "id_municipio"],
                                     partitions or gdp.sparkSession.sparkContext.defaultParallelism)
    return sinks.replace_table(ordered, table_path)


def stream_links(spark: SparkSession, inbox: str, staging_path: str, table_path: str, checkpoint: str, owner: str, as_of: str | None = None,
                 encoding: str = "ISO-8859-1", year_from_name: str | None = None, quarantine_path: str | None = None,
                 max_files_per_trigger: int | None = None) -> int:
    """SRC-09 + PIPE-02: new extract files of any mix of layouts, dropped into ``inbox``, go through staging into the table exactly once.

    Each micro-batch groups its files by header, checks each group against its years, stages them under the batch's
    number and rebuilds the years it touched.  The year comes from ``ano=YYYY`` folders
    or from the file name.  Returns the number of files this run loaded.
    """
    from ..streaming.incremental import each_batch_of_files

    def load(files: list[str], batch: int) -> int:
        load_links(read_links(spark, files, encoding, year_from_name=year_from_name), owner, staging_path, table_path, as_of,
                   quarantine_path=quarantine_path, transaction=(checkpoint, batch))
        return len(files)

    return each_batch_of_files(spark, inbox, checkpoint, load, max_files_per_trigger)


def stream_links_to_staging(spark: SparkSession, inbox: str, staging_path: str, checkpoint: str, raw_schema: T.StructType,
                            owner: str, as_of: str | None = None, encoding: str = "ISO-8859-1") -> int:
    """SRC-09 + PIPE-02 stage 1: new extract files of one header layout, dropped
    under ``inbox/ano=YYYY/``, go through stage 1 into staging exactly once.

    ``raw_schema`` lists the layout's text columns in file order plus ``ano``
    (filled from the folder name).  Returns the number of rows this run loaded.
    """
    from ..streaming.incremental import load_new_files

    return load_new_files(spark, inbox, staging_path, checkpoint, raw_schema, encoding=encoding,
                          transform=lambda df: links_stage1(df.drop("arquivo"), owner, as_of),
                          partition_by=("ano",))
