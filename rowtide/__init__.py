"""rowtide - change-log application and distribution on Spark.

Change packets (``seq, action, data, restriction``) are validated against a declared
:class:`~rowtide.contract.TableContract`, folded per key into a table snapshot with set-based
window/aggregate work, fanned out to replicas, and summarised as counters. 

Main entry points::

    from rowtide import TableContract, apply_log, run_destination, stream_destination
    result = apply_log(base_df, packets_df, contract)   # .outcomes, .effects, .table
"""

from rowtide.contract import ForeignKey, TableContract
from rowtide.operators.apply import ChangeResult, apply_changes
from rowtide.operators.segmented import apply_key_moves, apply_log, apply_segmented
from rowtide.plans.pipeline import run_destination
from rowtide.sources.capture import capture_changes, capture_diff, route_changes
from rowtide.sources.packets import encode_packets, parse_packets, read_packets, write_packets
from rowtide.streaming.stream import stream_destination

__all__ = [
    "ChangeResult", "ForeignKey", "TableContract", "apply_changes", "apply_key_moves", "apply_log", "apply_segmented",
    "capture_changes", "capture_diff", "encode_packets", "parse_packets", "read_packets", "route_changes",
    "run_destination", "stream_destination", "write_packets",
]
