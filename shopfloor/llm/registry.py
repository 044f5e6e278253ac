"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from shopfloor.llm.ann import op9_cross_polytope_neighbours
from shopfloor.llm.chat import ORACLE_OP8, op8_chat_round_trip
from shopfloor.llm.crosstoken import op12_cross_tokenizer_alignment
from shopfloor.llm.jaccard import op4_ngram_jaccard_join
from shopfloor.llm.langid import op3_kneser_ney_language
from shopfloor.llm.lexical import op13_lexical_retrieval_packing
from shopfloor.llm.mixing import op10_raked_mixture
from shopfloor.llm.packing import op6_linear_grouping_packing
from shopfloor.llm.quality import ORACLE_OP7, op7_adaptive_quality
from shopfloor.llm.runs import op11_periodic_runs
from shopfloor.llm.sharding import op1_hilbert_sharding
from shopfloor.llm.url_lists import ORACLE_OP2, op2_temporal_url_lists
from shopfloor.llm.warc import op5_zip_warc_round_trip

QUERIES = {
    "op1_hilbert_sharding": op1_hilbert_sharding,
    "op2_temporal_url_lists": op2_temporal_url_lists,
    "op3_kneser_ney_language": op3_kneser_ney_language,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_zip_warc_round_trip": op5_zip_warc_round_trip,
    "op6_linear_grouping_packing": op6_linear_grouping_packing,
    "op7_adaptive_quality": op7_adaptive_quality,
    "op8_chat_round_trip": op8_chat_round_trip,
    "op9_cross_polytope_neighbours": op9_cross_polytope_neighbours,
    "op10_raked_mixture": op10_raked_mixture,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_lexical_retrieval_packing": op13_lexical_retrieval_packing,
}

ORACLE = {
    "op2_temporal_url_lists": ORACLE_OP2,
    "op7_adaptive_quality": ORACLE_OP7,
    "op8_chat_round_trip": ORACLE_OP8,
}
