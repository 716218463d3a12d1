"""Column -> Column building blocks.

Everything here is a plain `pyspark.sql.Column` expression, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from seqflow.functions.scalar import (
    coerce_double,
    label_to_binary,
    magnitude,
    normalize_subpart,
    subpart_status,
    threshold_label,
    valid_valve,
)
from seqflow.functions.losses import bce_with_logits, focal_loss

__all__ = [
    "bce_with_logits",
    "coerce_double",
    "focal_loss",
    "label_to_binary",
    "magnitude",
    "normalize_subpart",
    "subpart_status",
    "threshold_label",
    "valid_valve",
]
