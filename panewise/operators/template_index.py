"""Very many templates at once: templates as a table, met by one equi join.

``functions.templates.demux`` writes each template into the plan, which suits a handful. Here a
template is a row, with null in the fields that it leaves open. Templates that set the same
fields are of one form. Each record is looked up once per form that occurs, under the values it
has in the fields of that form; so the plan does not grow with the number of templates, and the
records are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Templates up to so many rows are sent to every task; beyond it both sides are shuffled.
SENT_TO_ALL = 100_000
_FORM = "_form"


def _form(fields: list[str]) -> Column:
    """Which fields a template sets, one bit each."""
    bits = [F.when(F.col(field).isNotNull(), 1 << at).otherwise(0) for at, field in enumerate(fields)]
    return sum(bits[1:], bits[0])


def match_templates(
    df: DataFrame, templates: DataFrame, fields: list[str], name: str = "stream", sent_to_all: int = SENT_TO_ALL
) -> DataFrame:
    """(name, *df.columns): one row per template and record that fits it.

    ``templates`` has ``name`` and the ``fields``. A record whose field is null does not match a template
    that sets it. A template that sets nothing fits every record. Two templates that are alike
    both match. Only the number of templates per form reaches the driver, at most 2 ** len(fields)
    numbers.
    """
    if not fields:
        raise ValueError("templates need at least one field")
    formed = templates.select(F.col(name).alias("_name"), *[F.col(f).alias(f"_{f}") for f in fields], _form(fields).alias(_FORM))
    sizes = {row[_FORM]: row["count"] for row in formed.groupBy(_FORM).count().collect()}
    forms = F.array(*[F.lit(form) for form in sorted(sizes)]) if sizes else F.array().cast("array<int>")
    asked = df.withColumn(_FORM, F.explode(forms))

    def sets(at: int) -> Column:
        return F.col(_FORM).bitwiseAND(1 << at) != 0

    for at, field in enumerate(fields):
        asked = asked.where(~sets(at) | F.col(field).isNotNull())
    looked_up = asked.withColumns({f"_{f}": F.when(sets(at), F.col(f)) for at, f in enumerate(fields)})
    side = F.broadcast(formed) if sum(sizes.values()) <= sent_to_all else formed.hint("merge")
    keys = [_FORM, *[f"_{f}" for f in fields]]
    condition = F.lit(True)
    for key in keys:
        condition = condition & looked_up[key].eqNullSafe(side[key])
    return looked_up.join(side, condition).select(F.col("_name").alias(name), *[looked_up[c] for c in df.columns])
