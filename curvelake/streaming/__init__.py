"""Operators that also work on a streaming DataFrame.

They look at one row at a time, so ``readStream`` -> operator -> ``writeStream`` needs no
state and no watermark. Likelihood sums, heat cells and the other aggregations follow Spark's
own rules for streams (complete or update mode).
"""

from ..functions.scalars import first_token, lenient_double, quadrant, recode, rounded, year_of
from ..models.flows import flow_forward, flow_inverse, flow_log_prob, sinh_arcsinh
from ..models.nets import score_net
from ..operators.heat import tile_pixel, web_mercator
from ..sources.readers import extract_points, parse_delimited

__all__ = [
    "extract_points",
    "first_token",
    "flow_forward",
    "flow_inverse",
    "flow_log_prob",
    "lenient_double",
    "parse_delimited",
    "quadrant",
    "recode",
    "rounded",
    "score_net",
    "sinh_arcsinh",
    "tile_pixel",
    "web_mercator",
    "year_of",
]
