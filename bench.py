"""Bench: headline flows at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

The raw extracts and the typed tables that the flows read are written first,
untimed; a timed run reads them, runs the flow and writes its full result
(``noop``: every output column is computed).  Each flow runs $BENCH_RUNS times
(3) in one session with the settings the command line uses; ``queries`` holds
the medians, ``spread`` the fastest and slowest, ``value`` the medians' sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def flows_over(spark, sf_dir: str) -> dict[str, Callable]:
    """Name → function that gives the flow's frame, over extracts written here once."""
    from regstat import dims, schemas
    from regstat.operators import classify, profile, shape, vintage
    from regstat.plans import analyses, flows
    from regstat.plans.queries import AS_OF, OWNER, activity_dim, write_text
    from regstat.session import scratch_path
    from regstat.sources import fixtures as fx
    from regstat.sources import readers

    root = scratch_path(spark, "bench")

    def stored(name, df):
        df.write.parquet(f"{root}/{name}")
        return lambda: spark.read.parquet(f"{root}/{name}")

    raw_links = stored("raw_links", fx.raw_links(spark, sf_dir))
    layouts = [stored(f"layout{i}", f) for i, f in enumerate(fx.raw_estab_layouts(spark, sf_dir))]
    workbooks = [stored(f"workbook{i}", f) for i, f in enumerate(fx.raw_gdp_vintages(spark, sf_dir))]
    write_text(raw_links().drop("ano"), f"{root}/text")
    estab = lambda: flows.standardize_estab([f() for f in layouts], OWNER, activity_dim(spark), dims.size_dimension(spark), AS_OF)
    links_table = stored("links", flows.standardize_links(raw_links(), OWNER, AS_OF))
    estab_table = stored("estab", estab())
    gdp = lambda: flows.conformed_gdp([f() for f in workbooks], OWNER, AS_OF)
    stage = stored("harmonise", shape.normalize_headers(raw_links()))
    size = dims.size_dimension(spark).select(shape.qcol("setor_ibge")).distinct()
    return {
        "estab_standardize": estab,
        "links_standardize": lambda: flows.standardize_links(raw_links(), OWNER, AS_OF),
        "gdp_standardize": lambda: shape.sort_gdp(gdp()),
        "prj05_harmonize_links": lambda: vintage.harmonize_links(stage(), "ano"),
        "qry01_headcount": lambda: analyses.headcount(links_table()),
        "qry03_mean_pay": lambda: analyses.mean_pay(links_table()),
        "qry04_estab_breakdown": lambda: analyses.estab_breakdown(estab_table()),
        "qry05_gdp_growth": lambda: analyses.gdp_growth(gdp()),
        "qry06_gdp_rank": lambda: analyses.gdp_rank(gdp()),
        "agg04_null_profile": lambda: profile.null_profile(estab_table()),
        "agg06_column_profile": lambda: profile.column_profile(estab_table(), ["sigla_uf", "nat_jur", "setor_ibge", "cnae_2_subclasse"]),
        "snk07_infer_types": lambda: profile.infer_narrow_types(estab_table()),
        "lkp04_orphans": lambda: classify.orphans(estab_table(), size, "setor_ibge"),
        "src02_read_latin1": lambda: shape.normalize_headers(readers.read_raw(spark, f"{root}/text", encoding="ISO-8859-1")),
        "estab_table": lambda: estab_table().select(*schemas.SCHEMA_ESTAB_TABLE.fieldNames()),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from regstat.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="regstat-bench")
    times: dict[str, list[float]] = {}
    flows = flows_over(spark, sf_dir)
    for _ in range(runs):
        for name, flow in flows.items():
            t0 = time.perf_counter()
            flow().write.format("noop").mode("overwrite").save()
            times.setdefault(name, []).append(round(time.perf_counter() - t0, 3))
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    median = {k: round(statistics.median(v), 3) for k, v in times.items()}
    print(json.dumps({
        "metric": "headline_total_seconds",
        "value": round(sum(median.values()), 3),
        "unit": "sec",
        "queries": median,
        "spread": {k: [min(v), max(v)] for k, v in times.items()},
        "runs": runs,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
