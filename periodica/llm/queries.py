"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from periodica.llm.chat import OP2_SQL, op2_chat_prefix
from periodica.llm.embedding_join import op7_grid_order
from periodica.llm.line_runs import OP12_SQL, op12_line_runs
from periodica.llm.mixing import op3_source_mix
from periodica.llm.ngram_join import op8_prefix_tree
from periodica.llm.packing import op6_best_fit
from periodica.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from periodica.llm.quality_lines import op5_quality_lines
from periodica.llm.ranked_search import OP11_SQL, op11_strata_search
from periodica.llm.sharding import op1_sharding
from periodica.llm.toxicity import op9_toxic_crf
from periodica.llm.url_lists import OP4_SQL, op4_temporal_lists
from periodica.llm.weak_quality import op10_weak_quality

QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_chat_prefix, op3_source_mix, op4_temporal_lists, op5_quality_lines, op6_best_fit,
    op7_grid_order, op8_prefix_tree, op9_toxic_crf, op10_weak_quality, op11_strata_search,
    op12_line_runs, op13_prefix_trie)}
ORACLE = {"op2_chat_prefix": OP2_SQL, "op4_temporal_lists": OP4_SQL, "op11_strata_search": OP11_SQL,
          "op12_line_runs": OP12_SQL, "op13_prefix_trie": OP13_SQL}
