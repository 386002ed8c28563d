"""The command line over the flows, on the fixture extracts written as text."""

from pyspark.sql import functions as F

from regstat import cli
from regstat.sources import fixtures as fx
from regstat.sources import versions

SF = "/root/testdata/sf0.001"


def _write_text(df, path, partition=True):
    w = (df.write.option("sep", ";").option("header", "true").option("encoding", "ISO-8859-1")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").mode("overwrite"))
    (w.partitionBy("ano") if partition else w).csv(path)


def test_cli_estab_links_dims_report(spark, tmpdir_fresh):
    d = tmpdir_fresh
    for i, layout in enumerate(fx.raw_estab_layouts(spark, SF)):
        _write_text(layout, f"{d}/estab/layout{i}")
    spark.createDataFrame([(c,) for c in fx.fixture_codes()], "cnae_2_subclasse string").write.parquet(f"{d}/codes")
    cli.main(["estab", "--owner", "t", "--layout", f"{d}/estab/layout0", "--layout", f"{d}/estab/layout1",
              "--codes", f"{d}/codes", "--out", f"{d}/tb_estab", "--rejected", f"{d}/rej", "--salt-buckets", "2"],
             spark)
    n_orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert versions.read(spark, f"{d}/tb_estab").count() == n_orders
    assert spark.read.parquet(f"{d}/rej").count() == 0

    _write_text(fx.raw_links(spark, SF), f"{d}/links")
    cli.main(["links", "--owner", "t", "--encoding", "ISO-8859-1", "--input", f"{d}/links", "--partitioned",
              "--staging", f"{d}/stg", "--out", f"{d}/tb_links", "--salt-buckets", "2"], spark)
    links = versions.read(spark, f"{d}/tb_links")
    assert links.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert links.filter(F.col("uf").isNull()).count() == 0

    region = spark.read.parquet(f"{SF}/region.parquet")
    _write_text(region.select(F.col("r_regionkey").cast("string").alias("codigo"),
                              F.concat(F.lit(" "), "r_name").alias("descricao")), f"{d}/regiao", partition=False)
    cli.main(["dims", "--owner", "t", "--encoding", "ISO-8859-1", "--sheet", f"0_capa={d}/regiao",
              "--sheet", f"1_regiao={d}/regiao", "--sheet", f"9_notas={d}/regiao", "--out", f"{d}/dims"], spark)
    dim = versions.read(spark, f"{d}/dims/TB_RAIS_ESTABREGIAO")
    assert dim.count() == 5 and dim.filter(F.col("descricao").startswith(" ")).count() == 0

    cli.main(["report", "estab_breakdown", "--table", f"{d}/tb_estab", "--out", f"{d}/rep"], spark)
    rep = spark.read.parquet(f"{d}/rep")
    assert rep.filter(F.col("dimensao") == "sigla_uf").agg(F.sum("n_estab")).first()[0] == n_orders
