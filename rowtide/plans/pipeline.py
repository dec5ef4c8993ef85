"""Whole destination pipeline: apply at the destination, forward accepted packets, apply at targets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.operators.apply import ChangeResult
from rowtide.operators.distribute import Processor, accepted, apply_each_target, enabled_targets, fan_out
from rowtide.operators.segmented import apply_log
from rowtide.session import DEFAULT_BROADCAST_BYTES, broadcast_if_small


@dataclass
class PipelineResult:
    destination: ChangeResult
    forwarded: DataFrame  # accepted packets x targets (complete, disabled targets included)
    targets: ChangeResult  # replicas of the enabled targets


def run_destination(
    base: DataFrame,
    packets: DataFrame,
    routes: DataFrame,
    contract: TableContract,
    destination: str,
    target_bases: DataFrame,
    processor: Processor = apply_log,
    target_processor: Processor | None = None,
    target_contracts: dict[str, TableContract] | None = None,
    target_processors: dict[str, Processor] | None = None,
    **kw,
) -> PipelineResult:
    """Destination apply -> accepted stream -> fan-out -> enabled targets apply.

    ``processor`` is any DataFrame callable with the signature of :func:`apply_log`
    (``DataFrame.transform`` style plug-in). ``target_processor`` applies all targets in one call; ``target_contracts`` and
    ``target_processors`` give single targets a table and a function of their own.
    """
    dest = processor(base, packets, contract, **kw)
    extra = [c for c in packets.columns if c not in ("seq", "action", "data", "restriction") and c in dest.outcomes.columns]
    fwd = fan_out(accepted(dest.outcomes).select("seq", "action", "data", "restriction", *extra), routes.where(F.col("destination") == destination), destination)
    live = enabled_targets(routes.where(F.col("destination") == destination)).select("target")
    # the enabled-target list is configuration; broadcast after its size is measured
    live = broadcast_if_small(live, kw.get("broadcast_bytes", DEFAULT_BROADCAST_BYTES))
    to_apply = fwd.join(live, "target", "left_semi")
    tb = target_bases.join(live, "target", "left_semi")
    targets = apply_each_target(tb, to_apply, contract, target_contracts, target_processors, **kw) if target_processor is None else target_processor(tb, to_apply, contract, **kw)
    return PipelineResult(dest, fwd, targets)
