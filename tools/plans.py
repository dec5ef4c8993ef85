"""Print the physical plans of the core operators (explain), condensed to the operator tree.

usage: python tools/plans.py [sf_dir]  -> markdown on stdout (kept as PLANS.md)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from rowtide.operators.align import prepare  # noqa: E402
from rowtide.operators.apply import classify, _effect_columns, _key_from_packet  # noqa: E402
from rowtide.operators.fold import fold_effects, merge_into_base, summarize  # noqa: E402
from rowtide.functions.packets import rp, rv  # noqa: E402
from rowtide.operators.versions import match, version_intervals, with_restriction  # noqa: E402
from rowtide.plans import fixtures as fx  # noqa: E402
from rowtide.session import local_session  # noqa: E402

KEEP = re.compile(r"(Exchange|Window|HashAggregate|SortAggregate|BroadcastHashJoin|SortMergeJoin|Scan parquet|Union|"
                  r"WindowGroupLimit|BroadcastExchange|Expand|InMemoryTableScan|Sort \[)")


def condensed(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            out.append(line[:170])
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plans: what Catalyst chose before runtime re-planning
    c = fx.ACCOUNTS
    log = fx.accounts_log(spark, sf)
    p = prepare(log, c)
    t1 = classify(p.where(F.col("reject_reason").isNull() & (F.col("match_kind") == "pk")), c, F.lit(True))
    eff = t1.select(*_effect_columns(c, ["ts"], _key_from_packet(c)))
    base = fx.accounts_base(spark, sf)
    hits = base.select("user_id").join(F.broadcast(eff.select("user_id").distinct()), "user_id", "left_semi")
    folded = fold_effects(eff, hits, c)
    print("# Physical plans of the core operators\n")
    print("Generated by `python tools/plans.py` (AQE off, so these are the static plans; at run time AQE coalesces")
    print("partitions and splits skewed ones). Expression detail is cut; only the operator tree is kept.\n")
    print("## Fold: outcome per packet (accounts log)\n")
    print("The log is fully exchanged once, on (key, seq bucket). The other exchanges move chunk summaries only,")
    print("and every aggregate is partial before its exchange.\n\n```")
    print(condensed(folded))
    print("```\n\n## Final state per key (max_by, partial aggregation)\n\n```")
    print(condensed(summarize(folded, c)))
    print("```\n\n## Merge into the base (broadcast summary: the base is scanned, never shuffled)\n\n```")
    print(condensed(merge_into_base(base, summarize(folded, c), c, broadcast_bytes=0).hint("broadcast")))
    print("```\n\n## Restrictions on a column: rows hit, as of each packet (customers log; one round)\n")
    print("Base rows without changes of the column are streamed past the restrictions; the changed ones come from the chunked")
    print("scan. One join per set of restricted columns, whatever the number of packets.\n\n```")
    cust = fx.CUSTOMERS
    prepared = prepare(fx.barrier_log(spark, sf, "segment"), cust)
    full = classify(prepared.where("match_kind = 'pk'"), cust, F.lit(True)).select(*_effect_columns(cust, [], _key_from_packet(cust)))
    rows = fx.customer_old(spark, sf)
    done = fold_effects(full, rows.select("c_custkey"), cust)
    wide = with_restriction(prepared.where("match_kind = 'non_key'"), cust, {x: (F.col(rp(x)), F.col(rv(x))) for x in cust.names})
    intervals = version_intervals(rows, done, cust, ["c_mktsegment"], broadcast_bytes=0)
    print(condensed(match(intervals, wide, cust, ["c_mktsegment"], ["seq"], broadcast_bytes=0)))
    print("```")


if __name__ == "__main__":
    main()
