"""Column-level helpers: token validity, whitespace trim, vector algebra."""

from .columns import (  # noqa: F401
    ITEM_SENTINEL,
    NULL_TOKENS,
    USER_SENTINEL,
    md5_u60,
    normalized_query,
    parse_day,
    safe_div,
    valid_token,
    ws_trim,
)
from .vectors import constant_vector, cosine, dot, euclidean, norm, rank_key, score  # noqa: F401
