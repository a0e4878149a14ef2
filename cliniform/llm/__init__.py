"""Operators for preparing training corpora, with one query each.

``QUERIES`` maps query names to functions of (spark, folder); ``SQL`` holds the twins of those that SQL
can express.
"""

from .align import op11_align
from .mixing import op6_mix
from .quality import op8_quality
from .rules import op10_quality_rules
from .secrets import op3_secrets
from .simhash import op1_simhash
from .tokens import op4_bpe, op7_token_counts
from .topk import OP9_SQL, op9_topk
from .toxicity import op12_toxicity
from .turns import OP13_SQL, op13_turns
from .warc import OP5_SQL, op5_warc
from .wrapper import op2_extract

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_extract": op2_extract,
    "op3_secrets": op3_secrets,
    "op4_bpe": op4_bpe,
    "op5_warc": op5_warc,
    "op6_mix": op6_mix,
    "op7_token_counts": op7_token_counts,
    "op8_quality": op8_quality,
    "op9_topk": op9_topk,
    "op10_quality_rules": op10_quality_rules,
    "op11_align": op11_align,
    "op12_toxicity": op12_toxicity,
    "op13_turns": op13_turns,
}

SQL: dict[str, str] = {"op5_warc": OP5_SQL, "op9_topk": OP9_SQL, "op13_turns": OP13_SQL}
