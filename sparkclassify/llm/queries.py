"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from .bpe import op8_bpe
from .collocations import OP13_SQL, op13_collocations
from .conversations import OP11_SQL, op11_conversations
from .language import op1_language
from .mixing import op7_mixing
from .near_duplicates import OP3_SQL, op3_jaccard_join
from .pii import OP4_SQL, op4_personal_data
from .quality import OP9_SQL, op9_quality
from .repeats import OP10_SQL, op10_repeats
from .sharding import op2_sharding
from .simhash import op12_simhash
from .token_counts import op6_token_counts
from .top_k import OP5_SQL, op5_top_k

QUERIES = {
    "op1_language": op1_language,
    "op2_sharding": op2_sharding,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_personal_data": op4_personal_data,
    "op5_top_k": op5_top_k,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_repeats": op10_repeats,
    "op11_conversations": op11_conversations,
    "op12_simhash": op12_simhash,
    "op13_collocations": op13_collocations,
}
ORACLE_SQL = {
    "op3_jaccard_join": OP3_SQL,
    "op4_personal_data": OP4_SQL,
    "op5_top_k": OP5_SQL,
    "op9_quality": OP9_SQL,
    "op10_repeats": OP10_SQL,
    "op11_conversations": OP11_SQL,
    "op13_collocations": OP13_SQL,
}
