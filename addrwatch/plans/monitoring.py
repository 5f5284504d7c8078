"""All alert rules over all metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from addrwatch import config
from addrwatch.operators import alerts


def alert_states(ticks: Mapping[str, DataFrame], rules: Sequence[config.AlertRule] = tuple(config.ALERT_RULES)) -> DataFrame:
    """``(tick, alert, severity, labels, state)`` of every rule at every tick of its metric.

    ``ticks`` has ``(tick, *by, value)`` for each metric; ``labels`` maps the names in
    ``by`` to their values. A rule without its metric is refused.
    """
    missing = sorted({r.metric for r in rules} - set(ticks))
    if missing:
        raise ValueError(f"no ticks for {', '.join(missing)}")
    states = []
    for rule in rules:
        found = alerts.alerts(ticks[rule.metric], rule)
        pairs = [x for label in rule.by for x in (F.lit(label), F.col(label).cast("string"))]
        labels = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
        states.append(found.select("tick", "alert", "severity", labels.alias("labels"), "state"))
    return reduce(DataFrame.unionByName, states)
