"""The registered queries of this folder: name -> (query, SQL or None)."""

from corpus_pipeline import ORACLE_SQL, run

from .decontaminate import op9_decontamination
from .line_dedup import OP2_SQL, op2_line_dedup
from .lm_score import op5_lm_score
from .mixing import OP8_SQL, op8_mixing
from .near_dedup import op7_near_dedup
from .neighbours import OP10_SQL, op10_neighbours
from .quality import op6_quality
from .sharding import op4_sharding
from .token_counts import op3_token_counts
from .warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": (op1_warc, OP1_SQL),
    "op2_line_dedup": (op2_line_dedup, OP2_SQL),
    "op3_token_counts": (op3_token_counts, None),
    "op4_sharding": (op4_sharding, None),
    "op5_lm_score": (op5_lm_score, None),
    "op6_quality": (op6_quality, None),
    "op7_near_dedup": (op7_near_dedup, None),
    "op8_mixing": (op8_mixing, OP8_SQL),
    "op9_decontamination": (op9_decontamination, None),
    "op10_neighbours": (op10_neighbours, OP10_SQL),
    "pipeline": (run, ORACLE_SQL),
}
