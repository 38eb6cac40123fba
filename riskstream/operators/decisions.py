"""Turn a score into an explained decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decide(
    scored: DataFrame,
    flag_at: float,
    block_at: float,
    factors: dict[str, Column],
    snapshot: list[str],
    score: str = "score",
    block_when: Column | None = None,
) -> DataFrame:
    """``allow``, ``flag`` or ``block`` with confidence, factors and the state it rests on.

    Scores from ``flag_at`` are flagged, from ``block_at`` blocked; ``block_when``
    (a watchlist hit, say) blocks whatever the score. A row without a score is
    flagged for review. ``factors`` maps a name to the condition under which it
    contributed. ``snapshot`` names the columns to keep as the decision's record.
    """
    value = F.col(score)
    forced = F.coalesce(block_when, F.lit(False)) if block_when is not None else F.lit(False)
    decision = (
        F.when(forced | (value >= block_at), "block")
        .when(value.isNull() | (value >= flag_at), "flag")
        .otherwise("allow")
    )
    confidence = F.when(forced, F.lit(1.0)).otherwise(F.greatest(value, 1 - value))
    named = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.coalesce(hit, F.lit(False)).alias("hit"))
            for n, hit in factors.items()
        ]
    )
    return scored.withColumns(
        {
            "decision": decision,
            "confidence": confidence,
            "factors": F.filter(named, lambda f: f["hit"]),
            "snapshot": F.struct(*snapshot),
        }
    )
