"""The queries of this subpackage and the SQL of those that SQL can express."""

from skyloom.llm import (  # noqa: F401
    binslack, bitslices, bloom_lm, decontaminate, languages, merkle, packing, pivots, pseudonyms, secrets, simhash, substrings,
    toxicity,
)
from skyloom.llm.common import QUERIES  # noqa: F401

ORACLES = {
    "op4_decontaminate": decontaminate.OP4_SQL,
    "op7_pivot_index": pivots.OP7_SQL,
    "op8_substring_dedup": substrings.OP8_SQL,
    "op11_bit_sliced_search": bitslices.OP11_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
