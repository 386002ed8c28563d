"""Write PLANS.md: the physical operator tree of the headline flows (``explain("formatted")``
header section), over the same stored extracts as the bench, and the size of the methods that each stage compiles to.

usage: python tools/explain.py [SF_DIR]
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import flows_over  # noqa: E402
from regstat.session import SETTINGS, local_session  # noqa: E402


def tree(df) -> str:
    """The numbered operator tree that heads ``explain("formatted")``."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    head = plan.split("\n\n")[0]
    return re.sub(r"file:[^\s,\]]+", "…", head)


def method_sizes(df) -> list[int]:
    """Bytes of the largest generated method of each whole-stage subtree."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    limit = int(SETTINGS["spark.sql.codegen.hugeMethodLimit"])
    out = ["# Physical plans", "",
           f"`python tools/explain.py {sf}`: operator trees of the bench's flows over stored extracts (AQE on, so shuffles show as "
           "`Exchange` before runtime re-planning), and the bytes of the largest generated method of each whole-stage subtree. "
           f"A stage with a method over {limit} runs by operators, whose projections are generated in small methods.", ""]
    for name, flow in flows_over(spark, sf).items():
        df = flow()
        sizes = method_sizes(df)
        out += [f"## {name}", "", "```", tree(df), "```", "", f"Largest generated methods: {', '.join(map(str, sizes)) or 'none'}.", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
