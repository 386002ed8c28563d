"""Physical-plan checks for the scale claims: where the shuffles are, and where they are not."""

from pyspark.sql import functions as F

from regstat import dims
from regstat.operators import classify
from regstat.plans import analyses, flows
from regstat.sources import fixtures as fx
from regstat.sources import sinks


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> int:
    """Shuffle exchanges (broadcast exchanges are not shuffles)."""
    return sum(1 for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line)


def test_establishments_pipeline_is_map_only(spark, tmpdir_fresh):
    # raw layouts stored as files, so the plan starts at a plain scan like a real extract
    paths = []
    for i, layout in enumerate(fx.raw_estab_layouts(spark, "/root/testdata/sf0.001")):
        p = f"{tmpdir_fresh}/layout{i}"
        layout.write.parquet(p)
        paths.append(spark.read.parquet(p))
    df = flows.standardize_estab(paths, "t", dims.activity_dimension(spark, fx.fixture_codes()),
                                     dims.size_dimension(spark), as_of="2024-01-31")
    plan = plan_of(df)
    assert plan.count("BroadcastHashJoin") == 2
    assert shuffles(plan) == 0


def test_links_stage2_from_staging_is_map_only(spark, tmpdir_fresh):
    stage1 = flows.links_stage1(fx.raw_links(spark, "/root/testdata/sf0.001"), "t", "2024-01-31")
    sinks.append_staging(stage1, f"{tmpdir_fresh}/stg")
    typed = flows.links_stage2(spark.read.parquet(f"{tmpdir_fresh}/stg"), uf="SP")
    plan = plan_of(typed)
    assert shuffles(plan) == 0
    assert "PartitionFilters" in plan or "PushedFilters" in plan


def test_grouping_sets_pre_aggregate_before_one_shuffle(spark):
    df = spark.createDataFrame(
        [(2015, "SP", 1, 1, 1, 1, 100000, 1)] * 5 + [(2016, "MG", 2, 2, 2, 2, 200000, 2)],
        "ano int, uf string, ibge_subsetor int, faixa_etaria int, escolaridade_apos_2005 int, "
        "sexo_trabalhador int, cbo_ocupacao_2002 int, vinculo_ativo_31_12 int")
    plan = plan_of(analyses.headcount(df))
    assert shuffles(plan) == 1
    assert "partial_count" in plan and "Expand" in plan
    assert sum(r["n_vinculos"] for r in analyses.headcount(df).collect()) == 3 * 5   # 3 levels × active rows


def test_orphans_aggregate_partially_and_broadcast_the_codes(spark):
    fact = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"))
    dim = dims.bounded(spark.createDataFrame([("1",), ("2",)], "k string"), 2)
    plan = plan_of(classify.orphans(fact, dim, "k"))
    assert "partial_count" in plan and "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_unbounded_dimension_is_not_broadcast_blindly(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(100).select((F.col("id") % 10).alias("k"))
        dim = spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        out = classify.lookup(fact, dim, "k", {"v": "-1"})                 # no known bound: left to the planner
        assert "BroadcastHashJoin" not in plan_of(out)
        out = classify.lookup(fact, dims.bounded(dim, 50), "k", {"v": "-1"})   # built from a list of 50
        assert "BroadcastHashJoin" in plan_of(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_write_spreads_a_hot_partition(spark, tmpdir_fresh):
    import glob
    df = spark.range(4000).select(F.lit(2015).alias("ano"),
                                  F.when(F.col("id") % 3 == 0, "MG").otherwise("SP").alias("uf"), "id")
    # AQE would merge these tiny shuffle partitions into one; at scale they stay apart
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_partitioned(df, f"{tmpdir_fresh}/w", partition_by=("ano", "uf"), mode="overwrite",
                                salt_buckets=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = glob.glob(f"{tmpdir_fresh}/w/ano=2015/uf=SP/*.parquet")
    assert len(files) >= 2                                   # the hot state is written by several tasks
    assert spark.read.parquet(f"{tmpdir_fresh}/w").count() == 4000


def test_one_scan_for_accepted_and_rejected_rows(spark):
    from regstat.plans.queries import QUERIES
    for name in ("snk04_range_bucket", "snk05_validate"):
        assert plan_of(QUERIES[name](spark, "/root/testdata/sf0.001")).count("FileScan parquet") == 1


def test_analyses_do_not_sort_the_table(spark):
    from regstat.plans.queries import QUERIES
    for name in ("qry05_gdp_growth", "qry06_gdp_rank"):
        assert "rangepartitioning" not in plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_year_range_reaches_the_scan(spark, tmpdir_fresh):
    from regstat.sources import readers
    spark.range(40).select((F.col("id") % 8 + 2010).cast("int").alias("ano"), "id").write.partitionBy("ano").parquet(f"{tmpdir_fresh}/y")
    plan = plan_of(readers.in_years(spark.read.parquet(f"{tmpdir_fresh}/y"), 2011, 2012))
    assert "PartitionFilters: [isnotnull(ano" in plan and "Join" not in plan


def test_rebalanced_write_plan(spark, tmpdir_fresh):
    df = spark.range(100).select(F.lit(2015).alias("ano"), F.col("id"))
    plan = plan_of(df.hint("rebalance", "ano"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    sinks.write_partitioned(df, f"{tmpdir_fresh}/r", partition_by=("ano",), mode="overwrite")
    assert spark.read.parquet(f"{tmpdir_fresh}/r").count() == 100


def test_links_projections_compile_in_a_plain_session(spark):
    """Spark's default leaves a wide projection to the JVM's interpreter; the flow brings its own limit and keeps a lower one."""
    name, was = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    raw = spark.createDataFrame([], fx.raw_links(spark, "/root/testdata/sf0.001").schema)
    steps = [lambda: fx.raw_links(spark, "/root/testdata/sf0.001"), lambda: flows.links_stage1(raw, "t", "2024-01-31"),
             lambda: flows.standardize_links(raw, "t", "2024-01-31")]
    try:
        for step in steps:
            for given, want in (("65535", 8000), ("4000", 4000)):
                spark.conf.set(name, given)
                step()
                assert int(spark.conf.get(name)) == want
    finally:
        spark.conf.set(name, was)


def test_links_of_one_row_group_are_made_on_all_cores(spark, tmpdir_fresh):
    """A Parquet file of one row group is read by one task; the wide rows on top of it are made by all of them, none lost."""
    lines = spark.range(0, 4000, numPartitions=1).selectExpr(
        "id div 2 AS l_orderkey", "1 AS l_linenumber", "if(id % 50 = 0, null, id) AS l_partkey", "cast(id % 30 + 1 AS double) AS l_quantity",
        "cast(id AS double) AS l_extendedprice", "timestamp_ntz'1996-05-01 00:00:00' AS l_shipdate")
    lines.unionByName(lines.limit(10)).coalesce(1).write.parquet(f"{tmpdir_fresh}/lineitem.parquet")     # some rows twice
    raw = fx.raw_links(spark, tmpdir_fresh)
    assert raw.count() == 4010 and raw.filter("`Mun Trab` is null").count() == 81
    tasks = raw.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= spark.sparkContext.defaultParallelism
