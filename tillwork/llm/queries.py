"""All queries of the package, with their SQL checks."""

from tillwork.llm import (  # noqa: F401
    divergence,
    langid,
    mixing,
    nndescent,
    pieces,
    pii,
    sharding,
    shinglejoin,
    tokenfile,
    topk,
    urls,
    whitening,
    wordpiece,
)
from tillwork.llm.common import ORACLES, QUERIES  # noqa: F401
