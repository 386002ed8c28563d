"""Versioned tables and what stands on them: whole versions, corrected files, quarantine, streams, reports, profiles, marts, lookups."""

import os
import shutil
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regstat import dims, schemas
from regstat.operators import profile, shape, vintage
from regstat.plans import analyses, flows, marts, queries
from regstat.plans.queries import activity_dim, mixed_vintages, write_text
from regstat.sources import fixtures as fx
from regstat.sources import readers, sinks, versions
from regstat.streaming import incremental

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, rows, path, replaces=versions.everything, **kw):
    return versions.commit(spark.createDataFrame(rows, "ano int, uf string, v int"), path, ("ano", "uf"), replaces, **kw)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("ano", "uf", "v").collect())


# --- versions ---------------------------------------------------------------
def test_slices_are_replaced_as_a_whole(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/t"
    table(spark, [(2015, "SP", 1), (2015, "RO", 2), (2016, "SP", 3)], p)
    table(spark, [(2015, "SP", 9)], p, versions.same("ano"))              # RO of 2015 is gone, 2016 stays
    assert rows_of(versions.read(spark, p)) == [(2015, "SP", 9), (2016, "SP", 3)]
    assert rows_of(versions.read(spark, p, 1)) == [(2015, "RO", 2), (2015, "SP", 1), (2016, "SP", 3)]
    table(spark, [(2015, "SP", 10), (None, None, 4)], p, versions.nothing)  # adds, also to a slice that is there; null slices
    assert versions.read(spark, p).count() == 4 and versions.read(spark, p).filter("ano is null and uf is null").count() == 1
    plan = plan_of(versions.read(spark, p).filter("uf = 'SP'"))
    assert "PartitionFilters: [isnotnull(uf" in plan
    assert sorted(map(str, versions.changed(versions.latest(spark, p, 1), versions.latest(spark, p, 2)))) == sorted(map(str, [{"ano": "2015", "uf": "SP"}, {"ano": "2015", "uf": "RO"}]))
    table(spark, [], p, versions.where(lambda s: s["uf"] == "SP"))         # a load without rows still takes slices away
    assert versions.read(spark, p).filter("uf = 'SP'").count() == 0
    assert versions.vacuum(spark, p) >= 2 and versions.read(spark, p).count() == 1


def test_a_failed_replacement_leaves_the_table(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/t"
    df = spark.range(100).repartition(4)
    assert sinks.replace_table(df, p) == 100
    broken = sinks.read_back(spark, p).withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_table(broken, p)
    assert sinks.read_back(spark, p).count() == 100
    assert sinks.replace_table(sinks.read_back(spark, p).filter("id < 40"), p) == 40    # from itself
    assert sinks.replace_table(spark.range(0), p) == 0


def test_a_published_number_is_never_taken_twice(spark, tmpdir_fresh, monkeypatch):
    p, publish, raced = f"{tmpdir_fresh}/t", versions._publish, []

    def slower(spark_, path, version, load):
        if not raced:
            raced.append(1)
            table(spark, [(2016, "MG", 5)], p, versions.same("ano"))       # another load publishes first
        return publish(spark_, path, version, load)
    monkeypatch.setattr(versions, "_publish", slower)
    done = table(spark, [(2015, "SP", 1)], p, versions.same("ano"))
    assert done.number == 2 and rows_of(versions.read(spark, p)) == [(2015, "SP", 1), (2016, "MG", 5)]


def test_transactions_load_once_and_metrics_stay(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/t"
    for _ in range(2):
        table(spark, [(2015, "SP", 1), (2015, "SP", 2)], p, versions.nothing, transaction=("s", 0), metrics={"n": F.count(F.lit(1)), "soma": F.sum("v")})
    v = versions.latest(spark, p)
    assert v.number == 1 and v.notes["metrics"] == {"n": 2, "soma": 3} and versions.read(spark, p).count() == 2
    table(spark, [(2015, "SP", 3)], p, versions.nothing, transaction=("s", 1))
    assert versions.read(spark, p).count() == 3


def test_empty_loads_end(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/t"
    v = table(spark, [], p, metrics={"n": F.count(F.lit(1))})
    assert v.notes["metrics"].get("n", 0) in (0, None) and versions.read(spark, p).count() == 0 and versions.read(spark, p).columns == ["ano", "uf", "v"]
    raw = fx.raw_links(spark, SF).filter("ano = 2018")
    rejected = flows.load_links(raw, "t", f"{tmpdir_fresh}/stg", f"{tmpdir_fresh}/tb", "2024-01-31", years=(2010, 2012))
    assert versions.read(spark, f"{tmpdir_fresh}/tb").count() == 0 and rejected.count() == raw.count()


def test_types_widen_and_columns_are_added(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/t"
    versions.commit(spark.range(3).select(F.col("id").cast("smallint").alias("k")), p)
    versions.commit(spark.range(3).select((F.col("id") + 2**40).alias("k"), F.lit("x").alias("novo")), p, replaces=versions.nothing)
    back = versions.read(spark, p)
    assert back.schema["k"].dataType == T.LongType() and sorted(r["k"] for r in back.collect()) == [0, 1, 2, 2**40, 2**40 + 1, 2**40 + 2]
    assert back.filter("novo is null").count() == 3
    with pytest.raises(ValueError, match="does not take"):
        versions.commit(spark.createDataFrame([("a",)], "k string"), p, replaces=versions.nothing)


def test_dictionary_with_larger_values_loads(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/dim"
    sheet = lambda *rows: spark.createDataFrame(rows, "codigo string, nome string")
    assert flows.load_dimension(sheet(("1", "a"), ("2", "bb")), p, "t", "2024-01-31")["codigo"] == "smallint"
    types = flows.load_dimension(sheet(("70000", "c")), p, "t", "2024-01-31")
    assert (types["codigo"], types["nome"]) == ("int", "varchar(2)")
    assert versions.read(spark, p).schema["codigo"].dataType == T.IntegerType()
    assert flows.load_dimension(sheet(("A1", "d")), p, "t", "2024-01-31")["codigo"] == "varchar(11)"
    assert sorted(r["codigo"] for r in versions.read(spark, p).collect()) == ["1", "2", "70000", "A1"]


# --- headers ----------------------------------------------------------------
def put(path, data, encoding="latin-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data.encode(encoding))


def test_headers_are_read_by_tasks_and_kept(spark, tmpdir_fresh, monkeypatch):
    d, known = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/known"
    for i in range(120):
        put(f"{d}/ano={2014 + i % 3}/f {i}%.txt", ("A;B\n1;2\n", "B;A\n1;2\n")[i % 2])
    put(f"{d}/_oculto/x.txt", "C;D\n1;2\n")
    put(f"{d}/ano=2014/.y.txt", "C;D\n1;2\n")
    put(f"{d}/ano=2014/vazio.txt", "")
    put(f"{d}/ano=2014/aspas.txt", '"A\nb";"B"\n1;2\n')
    put(f"{d}/ano=2014/grande.txt", "A;B\n" + "1;2\n" * 300_000)
    opened, first = [], readers._first_records
    monkeypatch.setattr(readers, "_first_records", lambda s, files, enc: opened.append(len(files)) or first(s, files, enc))
    found = {r["path"].rsplit("/", 1)[1]: r["header"] for r in readers.file_headers(spark, d, "ISO-8859-1", known=known).collect()}
    assert len(found) == 122 and found["f 0%.txt"] == "A;B" and found["f 1%.txt"] == "B;A" and found["aspas.txt"] == '"A\nb";"B"'
    put(f"{d}/ano=2016/novo.txt", "A;B;C\n1;2;3\n")
    again = readers.file_headers(spark, d, "ISO-8859-1", known=known)
    assert again.count() == 123 and opened == [122, 1]                      # known files are not opened again
    raw = readers.read_raw(spark, d, "ISO-8859-1", known_headers=known)
    assert raw.filter("A = '1' and B = '2'").count() == 60 + 300_000 + 1 and raw.filter("A = '2'").count() == 60


def test_a_vintage_that_lacks_its_own_column_is_refused(spark, tmpdir_fresh):
    raw = fx.raw_links(spark, SF)
    for year in (2016, 2017):
        own = [c for c in raw.columns if c != "ano" and fx.in_vintage(c, year) and not (year == 2017 and shape.C.normalize_name(c) == "vl_rem_maio_cc")]
        raw.filter(F.col("ano") == year).select([shape.qcol(c) for c in own]).write.option("sep", ";").option("header", "true").option("encoding", "ISO-8859-1").csv(f"{tmpdir_fresh}/in/ano={year}")
    assert flows.read_links(spark, f"{tmpdir_fresh}/in/ano=2016").count() > 0
    with pytest.raises(ValueError, match=r"2017.*vl_rem_maio_cc"):
        flows.read_links(spark, f"{tmpdir_fresh}/in")
    vintage.check_estab(sorted(set(schemas.ESTAB_HEADERS.values()) - {"cep", "subsetor_ibge"}), {2013})
    with pytest.raises(ValueError, match="cep"):
        vintage.check_estab(sorted(set(schemas.ESTAB_HEADERS.values()) - {"cep"}), {2014})


# --- loads ------------------------------------------------------------------
def links_text(spark, path, year=2018, keep="true", spoil=()):
    """One extract file of a year; ``spoil`` maps row numbers to what happens to the record."""
    raw = fx.raw_links(spark, SF).filter(F.col("ano") == year).filter(keep).select([shape.qcol(c) for c in fx.raw_links(spark, SF).columns if c != "ano" and fx.in_vintage(c, year)])
    lines = [";".join(raw.columns)] + [";".join("" if v is None else v for v in r) for r in raw.collect()]
    for i in spoil:
        lines[i + 1] = lines[i + 1].rsplit(";", 1)[0] if i % 2 else lines[i + 1] + ";mais"
    put(path, "\n".join(lines) + "\n")
    return len(lines) - 1


def test_misfits_go_to_the_quarantine_and_counts_add_up(spark, tmpdir_fresh):
    d = tmpdir_fresh
    n = links_text(spark, f"{d}/in/ano=2018/a.txt", spoil=(3, 4, 10))
    load = lambda: flows.load_links(flows.read_links(spark, f"{d}/in"), "t", f"{d}/stg", f"{d}/tb", "2024-01-31", quarantine_path=f"{d}/bad")
    load()
    bad = versions.read(spark, f"{d}/bad").collect()
    assert len(bad) == 3 and {r["arquivo"] for r in bad} == {"a.txt"} and sum(r["registro_invalido"].endswith(";mais") for r in bad) == 2
    assert versions.read(spark, f"{d}/tb").count() == n - 3 and versions.read(spark, f"{d}/stg").count() == n
    links_text(spark, f"{d}/in/ano=2018/a.txt")                             # corrected
    load()
    assert versions.read(spark, f"{d}/tb").count() == n and versions.read(spark, f"{d}/bad").count() == 0


def test_corrected_file_leaves_nothing_behind(spark, tmpdir_fresh):
    d = tmpdir_fresh
    whole = fx.raw_links(spark, SF).filter("ano = 2018").withColumn("arquivo", F.lit("a"))
    ro = F.coalesce(F.col("Município").startswith("11"), F.lit(False))
    for raw in (whole, whole.filter(~ro)):
        flows.load_links(raw, "t", f"{d}/stg", f"{d}/tb", "2024-01-31")
    assert versions.read(spark, f"{d}/tb").count() == versions.read(spark, f"{d}/stg").count() == whole.filter(~ro).count() < whole.count()
    assert versions.read(spark, f"{d}/tb").filter("uf = 'RO'").count() == 0
    before = versions.latest(spark, f"{d}/tb").number
    flows.rebuild_links(spark, f"{d}/stg", f"{d}/tb")                        # nothing is new: no version is made
    assert versions.latest(spark, f"{d}/tb").number == before


def test_filter_over_every_column_is_planned_in_seconds(spark, tmpdir_fresh):
    """Renames above such a filter must not double the optimizer's inferred constraints (2 ** 30 of them before)."""
    d, flag = tmpdir_fresh, "spark.sql.constraintPropagation.enabled"
    layouts = fx.raw_estab_layouts(spark, SF)
    for i, f in enumerate(layouts):
        f.write.parquet(f"{d}/layout{i}")
    every = lambda f: f.filter(F.pmod(F.xxhash64(*[shape.qcol(c) for c in f.columns]), F.lit(2)) == 0)
    some = [every(spark.read.parquet(f"{d}/layout{i}")) for i in range(len(layouts))]
    t = time.time()
    plan_of(flows.standardize_estab(some, "t", activity_dim(spark), dims.size_dimension(spark), "2024-01-31"))
    flows.load_estab(some, "t", activity_dim(spark), dims.size_dimension(spark), f"{d}/estab", "2024-01-31")
    fx.raw_links(spark, SF).write.parquet(f"{d}/links")
    flows.load_links(every(spark.read.parquet(f"{d}/links")), "t", f"{d}/stg", f"{d}/tb", "2024-01-31")
    assert time.time() - t < 90 and spark.conf.get(flag) == "true"
    assert versions.read(spark, f"{d}/estab").count() == sum(f.count() for f in some)


def test_load_report_equals_the_profiles(spark, tmpdir_fresh):
    flows.load_estab(fx.raw_estab_layouts(spark, SF), "t", activity_dim(spark), dims.size_dimension(spark), f"{tmpdir_fresh}/t", "2024-01-31")
    got = {(r["medida"], r["coluna"]): r["valor"] for r in profile.load_report(spark, f"{tmpdir_fresh}/t").collect()}
    back = versions.read(spark, f"{tmpdir_fresh}/t")
    assert got["linhas", ""] == back.count() and got["total", "qtd_vinc_ativos"] == profile.total(back).first()[0]
    assert {k[1]: v for k, v in got.items() if k[0] == "nulos"} == {r[0]: r[1] for r in profile.null_profile(back).collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == "menos_um"} == {r[0]: r[1] for r in profile.sentinel_profile(back).collect()}
    by_uf = {r["sigla_uf"]: (r["soma_vinc_ativos"], r["n_municipio"]) for r in profile.by_uf_summary(back).collect()}
    assert all((got["total_uf", s], got["linhas_uf", s]) == by_uf.get(int(c), (0, 0)) for c, s in dims.UF_CODES)


# --- stream -----------------------------------------------------------------
def test_stream_of_mixed_layouts_exactly_once(spark, tmpdir_fresh):
    d = tmpdir_fresh
    run = lambda: flows.stream_links(spark, f"{d}/in", f"{d}/stg", f"{d}/tb", f"{d}/ckpt", "t", "2024-01-31")
    mixed_vintages(spark, SF, f"{d}/in", range(2014, 2018))
    assert run() >= 4 and run() == 0
    mixed_vintages(spark, SF, f"{d}/in", range(2018, 2021))
    assert run() >= 3
    n, staged = versions.read(spark, f"{d}/tb").count(), versions.latest(spark, f"{d}/stg").number
    assert n == fx.raw_links(spark, SF).count()
    last = max(int(f) for f in os.listdir(f"{d}/ckpt/commits") if f.isdigit())
    for f in (f"{d}/ckpt/commits/{last}", f"{d}/ckpt/commits/.{last}.crc"):
        if os.path.exists(f):
            shutil.move(f, f"{d}/taken{f.count('.')}")                       # as if the run had died before its last commit
    assert run() >= 3                                                        # the batch runs again and adds nothing
    assert versions.read(spark, f"{d}/tb").count() == n and versions.latest(spark, f"{d}/stg").number == staged


def test_a_late_file_with_another_header_is_refused_in_its_batch(spark, tmpdir_fresh):
    d, schema = tmpdir_fresh, T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    load = lambda: incremental.load_new_files(spark, f"{d}/in", f"{d}/out", f"{d}/ckpt", schema)
    put(f"{d}/in/f1.txt", "a;b\n1;2\n")
    assert load() == 1
    put(f"{d}/in/f2.txt", "b;a\n1;2\n")
    with pytest.raises(ValueError, match="f2.txt"):
        load()
    assert versions.read(spark, f"{d}/out").count() == 1


# --- profiles, marts, lookups ---------------------------------------------------
def test_profile_without_row_copies_in_an_expand(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("smallint").alias("a"), F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("b"), F.lit(None).cast("int").alias("c"))
    out = profile.column_profile(df)
    assert "Expand" not in plan_of(out)
    assert {tuple(r) for r in out.collect()} == {("a", "6", 1, 7), ("b", "999", 3, 334), ("c", None, None, 0)}
    state = profile.sketched_profile(df.withColumn("ano", F.pmod(F.col("a"), F.lit(3))), ["a", "b"])
    about = {r["coluna"]: r["n_distintos"] for r in profile.merge_sketches(state).collect()}
    assert about["a"] == 7 and abs(about["b"] - 334) < 17


def test_profile_and_marts_read_changed_slices_only(spark, tmpdir_fresh, monkeypatch):
    d, read = tmpdir_fresh, []
    rows = versions.rows
    monkeypatch.setattr(versions, "rows", lambda s, p, v, only=None: read.append([x for x in v.slices if only is None or only(versions.slice_values(x))]) or rows(s, p, v, only))
    typed = flows.standardize_links(fx.raw_links(spark, SF), "t", "2024-01-31")
    versions.commit(typed, f"{d}/t", ("ano", "uf"))
    fresh = lambda: marts.result(spark, "headcount", f"{d}/m")
    marts.refresh(spark, "headcount", f"{d}/t", f"{d}/m")
    full = lambda: sorted(map(str, analyses.headcount(versions.read(spark, f"{d}/t")).collect()))
    by = analyses.headcount(typed).columns
    assert sorted(map(str, fresh().select(*by).collect())) == full()
    versions.commit(typed.filter("ano = 2015 and uf = 'SP' and idade > 30"), f"{d}/t", ("ano", "uf"), versions.same("ano", "uf"))
    versions.commit(typed.limit(0), f"{d}/t", ("ano", "uf"), versions.where(lambda s: s == {"ano": "2016", "uf": "RO"}))   # a slice that is gone
    read.clear()
    assert len(marts.refresh(spark, "headcount", f"{d}/t", f"{d}/m")) == 2 and read[0] == ["ano=2015/uf=SP"]
    assert sorted(map(str, fresh().select(*by).collect())) == full()
    assert marts.refresh(spark, "headcount", f"{d}/t", f"{d}/m") == []
    cols = ["municipio", "sexo_trabalhador", "vl_remun_media_nom"]
    profile.refresh_profile(spark, f"{d}/t", f"{d}/p", cols)
    versions.commit(typed.filter("ano = 2014 and idade > 40"), f"{d}/t", ("ano", "uf"), versions.same("ano"))
    read.clear()
    got = profile.refresh_profile(spark, f"{d}/t", f"{d}/p", cols)
    assert all(x.startswith("ano=2014/") for x in read[0])
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in profile.column_profile(versions.read(spark, f"{d}/t"), cols).collect()}


def test_lookup_reads_few_rows(spark, tmpdir_fresh):
    df = spark.range(400_000).select(F.lit("SP").alias("uf"), (F.xxhash64("id") % 5000 + 355_0000).cast("int").alias("municipio"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    versions.commit(df, f"{tmpdir_fresh}/t", ("uf",), sort_by=flows.LOOKUP, options={**flows.bloom_filters(flows.LOOKUP), "parquet.block.size": str(1 << 20)})
    found = flows.links_of_place(spark, f"{tmpdir_fresh}/t", 3550017, "SP")
    assert len(found.collect()) == df.filter("municipio = 3550017").count() > 0

    def scans(node):
        if "Scan parquet" in node.nodeName():
            yield int(node.metrics().apply("numOutputRows").value())
        inner = [node.executedPlan()] if node.nodeName().startswith("AdaptiveSparkPlan") else [node.children().apply(i) for i in range(node.children().size())]
        for child in inner:
            yield from scans(child)
    assert sum(scans(found._jdf.queryExecution().executedPlan())) < 40_000


# --- disk -------------------------------------------------------------------
def shuffle_files(spark):
    java = spark._jvm
    kept = java.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in java.scala.jdk.javaapi.CollectionConverters.asJava(kept) if f.getName().startswith("shuffle_")}


def loads_of(path):
    return [f for f in os.listdir(f"{path}/_dados") if f.startswith("carga=")]


def test_shuffle_files_go_with_their_job(spark, tmpdir_fresh):
    before, name = shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df = spark.range(2000).selectExpr("cast(id % 3 + 2015 AS int) AS ano", "id")
    versions.commit(df, f"{tmpdir_fresh}/t", ("ano",))
    sinks.append_staging(df, f"{tmpdir_fresh}/s", salt_buckets=3)
    assert not shuffle_files(spark) - before and spark.conf.get(name, None) is None       # the caller's setting is back
    assert versions.read(spark, f"{tmpdir_fresh}/t").count() == spark.read.parquet(f"{tmpdir_fresh}/s").count() == 2000


def test_rounds_write_every_row_once(spark, tmpdir_fresh):
    rows = [(y, uf, i) for i, y in enumerate((None, 2009, 2010, 2015, 2016, 2023, -1)) for uf in ("SP", None) for _ in range(2)]
    df = spark.createDataFrame(rows, "ano int, uf string, v int")
    want = sorted(rows, key=str)
    for n in (1, 2, 8, 50):
        made = versions.commit(df, f"{tmpdir_fresh}/t{n}", ("ano", "uf"), rounds=n)
        sinks.append_staging(df, f"{tmpdir_fresh}/s{n}", ("ano", "uf"), salt_buckets=2, rounds=n)
        for back in (versions.read(spark, f"{tmpdir_fresh}/t{n}"), spark.read.parquet(f"{tmpdir_fresh}/s{n}")):
            assert sorted((tuple(r) for r in back.select("ano", "uf", "v").collect()), key=str) == want
        assert made.number == 1 and len(made.sizes) == 1 and len(made.slices) == 14                    # one load, published once
    sinks.append_staging(df, f"{tmpdir_fresh}/s8", ("ano", "uf"), replace_partitions=True, rounds=8)
    assert spark.read.parquet(f"{tmpdir_fresh}/s8").count() == len(rows)
    with pytest.raises(ValueError, match="rounds"):
        versions.commit(df, f"{tmpdir_fresh}/m", ("ano", "uf"), rounds=2, metrics={"n": F.count(F.lit(1))})


def test_a_kept_version_count_frees_replaced_loads(spark, tmpdir_fresh, monkeypatch):
    raw, told, commit = fx.raw_links(spark, SF).filter("ano >= 2017"), [], versions.commit
    monkeypatch.setattr(versions, "commit", lambda df, path, *a, **k: told.append(k.get("gathered")) or commit(df, path, *a, **k))
    stg, tb = f"{tmpdir_fresh}/stg", f"{tmpdir_fresh}/tb"
    for keep, loads in ((None, 1), (None, 2), (1, 1)):
        rejected = flows.load_links(raw, "t", stg, tb, "2024-01-31", (2017, 2017), keep=keep, rounds=2 if keep else None)
        assert len(loads_of(stg)) == len(loads_of(tb)) == loads
    assert versions.read(spark, stg).count() == raw.count() and versions.read(spark, tb).count() == raw.filter("ano = 2017").count()
    assert rejected.count() == raw.filter("ano > 2017").count()                    # still readable
    assert told == [None, True] * 3                                                # staging is shuffled, the table not again


def test_many_small_files_are_still_brought_together(spark, tmpdir_fresh):
    at = lambda files, loads=1: versions.Version(1, T.StructType(), ("ano", "arquivo", "uf"), {f"ano=2015/arquivo=f{i}/uf=SP": ("x",) * loads for i in range(files)} | {f"ano={versions.NULL_SLICE}/arquivo=f/uf=SP": ("x",)})
    assert flows._gathered(at(flows.FEW), [2015]) and not flows._gathered(at(flows.FEW + 1), [2015]) and not flows._gathered(at(1, flows.FEW + 1), [2015])
    raw = fx.raw_links(spark, SF).filter("ano = 2018")
    some = raw.withColumn("arquivo", F.concat(F.lit("f"), F.col("Idade").cast("int") % 20))
    flows.load_links(some, "t", f"{tmpdir_fresh}/stg", f"{tmpdir_fresh}/tb", "2024-01-31")
    assert not flows._gathered(versions.latest(spark, f"{tmpdir_fresh}/stg"), [2018])
    assert versions.read(spark, f"{tmpdir_fresh}/tb").count() == raw.count()


def test_text_extracts_are_packed(spark, tmpdir_fresh, monkeypatch):
    monkeypatch.setitem(queries.PACKED, "maxRecordsPerFile", "100")
    before = shuffle_files(spark)
    df = spark.range(250).repartition(2, "id").selectExpr("cast(id AS string) AS `Mês`", "if(id % 9 = 0, null, ' ñ;\"á ') AS t", "cast(id % 2 + 2015 AS int) AS ano")
    write_text(df.coalesce(1), f"{tmpdir_fresh}/x", partition_by=("ano",))
    assert not shuffle_files(spark) - before
    files = [f for y in (2015, 2016) for f in os.listdir(f"{tmpdir_fresh}/x/ano={y}") if f.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".gz") for f in files)                # at most 100 records each
    back = readers.read_raw(spark, f"{tmpdir_fresh}/x", "ISO-8859-1").select("Mês", "t", "ano")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
