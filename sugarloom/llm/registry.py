"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from sugarloom.llm.byte_bpe import op13_byte_bpe
from sugarloom.llm.decontaminate import op4_decontaminate
from sugarloom.llm.html_blocks import op10_html_blocks
from sugarloom.llm.lm_scoring import op1_lm_scoring
from sugarloom.llm.mixing import OP9_SQL, op9_mixing
from sugarloom.llm.ngram_join import op2_ngram_join
from sugarloom.llm.paragraph_dedup import op3_paragraph_dedup
from sugarloom.llm.pii import op7_pii
from sugarloom.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from sugarloom.llm.quality import op8_quality
from sugarloom.llm.toxicity import op5_toxicity
from sugarloom.llm.url_filter import op6_url_filter
from sugarloom.llm.vector_codes import OP12_SQL, op12_vector_codes

QUERIES = {"op1_lm_scoring": op1_lm_scoring, "op2_ngram_join": op2_ngram_join, "op3_paragraph_dedup": op3_paragraph_dedup, "op4_decontaminate": op4_decontaminate, "op5_toxicity": op5_toxicity, "op6_url_filter": op6_url_filter, "op7_pii": op7_pii, "op8_quality": op8_quality, "op9_mixing": op9_mixing, "op10_html_blocks": op10_html_blocks, "op11_prefix_trie": op11_prefix_trie, "op12_vector_codes": op12_vector_codes, "op13_byte_bpe": op13_byte_bpe}
ORACLE_SQL = {"op9_mixing": OP9_SQL, "op11_prefix_trie": OP11_SQL, "op12_vector_codes": OP12_SQL}
