"""Defaults shared by batch jobs, streams and queries."""

from __future__ import annotations

# Vector sizes, model name and limits of the data product.
DIMS = (384, 192, 96, 48)
MODEL_NAME = "mixedbread-ai/mxbai-embed-xsmall-v1"
ENCODE_BATCH = 256
# Bytes of text after which a batch is full before it has that many texts.
ENCODE_BYTES = 1 << 20
# Bytes of a layer's files that one task of a load reads: compressed, and costly to clean or encode.
LAYER_SPLIT = 8 << 20
# Bytes of a batch that a load sends to Python workers.
ARROW_BYTES = 4 << 20
TOP_K = 10
MATCH_THRESHOLD = 1
POLL_SECONDS = 300
FETCH_PAGE = 100
STATE_KEY = "last_fetch_time"
ABS_URL = "https://arxiv.org/abs/"
PDF_URL = "https://arxiv.org/pdf/"
NEW_ID_PATTERN = r"^\d{4}\.\d{4,5}$"
OLD_ID_PATTERN = r"^[a-z-]+/\d{7}$"

# Norms are floored here before a division, so a zero vector stays zero.
NORM_FLOOR = 1e-12
# Distances are compared at this many decimals: copies of one vector then tie
# exactly, whatever order a sum was taken in, and the id decides.
TIE_DECIMALS = 12

# Largest sets that may pass through the driver or be broadcast.
MAX_BROADCAST_QUERIES = 4096
MAX_BROADCAST_KEYS = 1_000_000


def nested_dims(full: int) -> tuple[int, ...]:
    """Full size, half, quarter and eighth: the ratios of ``DIMS``."""
    return (full, full // 2, full // 4, full // 8)
