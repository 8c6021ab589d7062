"""Queries of the subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from .ann_tree import op2_ann_tree
from .decontaminate import op10_decontamination
from .html_wrapper import op6_html_wrapper
from .lm_score import op9_lm_score
from .ngram_join import OP1_SQL, op1_ngram_jaccard_join
from .packing import op13_packing
from .pii import op7_pii
from .secrets import op4_secret_forest
from .sentencepiece_scan import op8_sentencepiece
from .spelling import OP11_SQL, op11_spelling
from .token_alignment import op12_token_alignment
from .toxicity import op3_toxicity
from .warc import OP5_SQL, op5_warc

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_ann_tree": op2_ann_tree,
    "op3_toxicity": op3_toxicity,
    "op4_secret_forest": op4_secret_forest,
    "op5_warc": op5_warc,
    "op6_html_wrapper": op6_html_wrapper,
    "op7_pii": op7_pii,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_lm_score": op9_lm_score,
    "op10_decontamination": op10_decontamination,
    "op11_spelling": op11_spelling,
    "op12_token_alignment": op12_token_alignment,
    "op13_packing": op13_packing,
}

ORACLES = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op5_warc": OP5_SQL,
    "op11_spelling": OP11_SQL,
}
