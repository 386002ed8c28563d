"""Command line over the composed flows (what the reference's notebooks do with prompts).

    python -m regstat.cli estab --layout OLD_GLOB --layout NEW_GLOB --codes CODES.parquet \\
        --out /warehouse/estab --owner NAME
    python -m regstat.cli links --input 'extracts/ano=*/' --staging /stg/links --out /warehouse/links --owner NAME
    python -m regstat.cli gdp --vintage a.csv --vintage b.csv --out /warehouse/gdp --owner NAME
    python -m regstat.cli dims --sheet 1_natureza=nat.csv --sheet 2_porte=porte.csv --out /warehouse/dims --owner NAME
    python -m regstat.cli report estab_breakdown --table /warehouse/estab --out /reports/breakdown

Every command is one Spark job graph over all years; nothing is looped per year or state.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from . import dims
from .plans import analyses, flows, marts
from .session import SETTINGS
from .sources import readers, sinks, versions


def _read_table(spark: SparkSession, path: str, a) -> DataFrame:
    """A workbook export: its headers and values may hold line breaks, so text is read record by record."""
    if a.format == "parquet":
        return spark.read.parquet(path)
    return readers.read_raw(spark, path, encoding=a.encoding, sep=a.sep, multi_line=True)


def cmd_estab(spark, a) -> None:
    layouts = [flows.read_estab(spark, p, a.encoding, a.sep, a.year_pattern, a.known_headers) for p in a.layout]
    codes = spark.read.parquet(a.codes)
    rejected = flows.load_estab(layouts, a.owner, dims.activity_dimension(spark, codes), dims.size_dimension(spark),
                                a.out, salt_buckets=a.salt_buckets, staging_path=a.staging, quarantine_path=a.quarantine)
    if a.rejected:
        rejected.write.mode("overwrite").parquet(a.rejected)


def cmd_links(spark, a) -> None:
    raw = flows.read_links(spark, a.input, a.encoding, a.sep, None if a.partitioned else a.year_pattern, a.known_headers)
    years = tuple(a.years) if a.years else None
    rejected = flows.load_links(raw, a.owner, a.staging, a.out, years=years, salt_buckets=a.salt_buckets, quarantine_path=a.quarantine)
    if a.rejected:
        rejected.write.mode("overwrite").parquet(a.rejected)


def cmd_gdp(spark, a) -> None:
    vintages = [_read_table(spark, p, a) for p in a.vintage]
    flows.load_gdp([v for v in vintages if not v.isEmpty()], a.owner, a.out)


def cmd_dims(spark, a) -> None:
    sheets = dict(s.split("=", 1) for s in a.sheet)
    names = readers.dimension_table_names(list(sheets), a.prefix, a.skip_head, a.skip_tail)
    for sheet, table in names.items():
        dim, _ = flows.typed_dimension(_read_table(spark, sheets[sheet], a), a.owner)
        sinks.write_dimension(dim, f"{a.out.rstrip('/')}/{table}")


REPORTS = {
    "headcount": analyses.headcount,
    "headcount_by_size": analyses.headcount_by_size,
    "mean_pay": analyses.mean_pay,
    "estab_breakdown": analyses.estab_breakdown,
    "gdp_growth": analyses.gdp_growth,
    "gdp_rank": analyses.gdp_rank,
}


def cmd_report(spark, a) -> None:
    if a.mart:
        marts.refresh(spark, a.name, a.table, a.mart)
    result = marts.result(spark, a.name, a.mart) if a.mart else REPORTS[a.name](versions.read(spark, a.table))
    result.write.mode("overwrite").parquet(a.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="regstat")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp, text=True):
        sp.add_argument("--owner", required=True)
        if text:
            sp.add_argument("--encoding", default="cp1252")
            sp.add_argument("--sep", default=";")

    e = sub.add_parser("estab", help="establishment extracts → typed table partitioned by year")
    common(e)
    e.add_argument("--layout", action="append", required=True, help="files of one header layout (repeat)")
    e.add_argument("--codes", required=True, help="Parquet with column cnae_2_subclasse (known codes)")
    e.add_argument("--out", required=True)
    e.add_argument("--rejected")
    e.add_argument("--quarantine", help="table of records that do not fit their header")
    e.add_argument("--known-headers", help="table that keeps file headers from run to run")
    e.add_argument("--year-pattern", default=r"(20\d{2})")
    e.add_argument("--staging", help="staging folder (default: beside the table)")
    e.add_argument("--salt-buckets", type=int, help="fixed number of writers per year (default: by size)")
    e.set_defaults(fn=cmd_estab)

    li = sub.add_parser("links", help="employment-link extracts → staging → typed table by (ano, uf)")
    common(li)
    li.add_argument("--input", required=True)
    li.add_argument("--staging", required=True)
    li.add_argument("--out", required=True)
    li.add_argument("--rejected")
    li.add_argument("--years", type=int, nargs=2)
    li.add_argument("--partitioned", action="store_true", help="input folders are ano=YYYY")
    li.add_argument("--quarantine", help="table of records that do not fit their header")
    li.add_argument("--known-headers", help="table that keeps file headers from run to run")
    li.add_argument("--year-pattern", default=r"(20\d{2})")
    li.add_argument("--salt-buckets", type=int, help="fixed number of writers per (year, state) (default: by size)")
    li.set_defaults(fn=cmd_links)

    g = sub.add_parser("gdp", help="GDP workbook exports → table, fully replaced")
    common(g)
    g.add_argument("--vintage", action="append", required=True)
    g.add_argument("--format", choices=("text", "parquet"), default="text")
    g.add_argument("--out", required=True)
    g.set_defaults(fn=cmd_gdp)

    d = sub.add_parser("dims", help="dictionary sheets → one dimension table each")
    common(d)
    d.add_argument("--sheet", action="append", required=True, help="SHEET=PATH, in workbook order")
    d.add_argument("--format", choices=("text", "parquet"), default="text")
    d.add_argument("--prefix", default="tb_rais_estab")
    d.add_argument("--skip-head", type=int, default=1)
    d.add_argument("--skip-tail", type=int, default=1)
    d.add_argument("--out", required=True)
    d.set_defaults(fn=cmd_dims)

    r = sub.add_parser("report", help="one of the analyses over a loaded table")
    r.add_argument("name", choices=sorted(REPORTS))
    r.add_argument("--table", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--mart", help=f"folder that keeps the report's partial aggregates ({', '.join(marts.MARTS)}): only changed slices are read")
    r.set_defaults(fn=cmd_report)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"regstat-{args.cmd}").config(map=SETTINGS).getOrCreate()
    args.fn(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
