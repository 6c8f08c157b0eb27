"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from .ann_ivfpq import op2_ann_ivfpq
from .bpe_automaton import op5_bpe_automaton
from .code_compression import ORACLE as CODES_SQL
from .code_compression import op12_code_compression
from .minhash_dedup import ORACLE as DEDUP_SQL
from .minhash_dedup import op3_minhash_dedup
from .name_join import ORACLE as NAMES_SQL
from .name_join import op11_name_join
from .packing import op1_length_buckets, pack_sql
from .phrase_index import ORACLE as PHRASES_SQL
from .phrase_index import op13_phrase_index
from .quality_nbsvm import op4_quality_nbsvm
from .secret_scan import op8_secret_scan
from .sharding import ORACLE as SHARDS_SQL
from .sharding import op7_minimax_shards
from .token_counts import op9_token_counts
from .topk_kdtree import ORACLE as TOPK_SQL
from .topk_kdtree import op10_topk_kdtree
from .warc_fixity import ORACLE as FIXITY_SQL
from .warc_fixity import op6_warc_fixity

QUERIES = {
    "op1_length_buckets": op1_length_buckets,
    "op2_ann_ivfpq": op2_ann_ivfpq,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_quality_nbsvm": op4_quality_nbsvm,
    "op5_bpe_automaton": op5_bpe_automaton,
    "op6_warc_fixity": op6_warc_fixity,
    "op7_minimax_shards": op7_minimax_shards,
    "op8_secret_scan": op8_secret_scan,
    "op9_token_counts": op9_token_counts,
    "op10_topk_kdtree": op10_topk_kdtree,
    "op11_name_join": op11_name_join,
    "op12_code_compression": op12_code_compression,
    "op13_phrase_index": op13_phrase_index,
}

ORACLE_SQL: dict[str, str] = {
    "op1_length_buckets": pack_sql(),
    "op3_minhash_dedup": DEDUP_SQL,
    "op6_warc_fixity": FIXITY_SQL,
    "op7_minimax_shards": SHARDS_SQL,
    "op10_topk_kdtree": TOPK_SQL,
    "op11_name_join": NAMES_SQL,
    "op12_code_compression": CODES_SQL,
    "op13_phrase_index": PHRASES_SQL,
}
