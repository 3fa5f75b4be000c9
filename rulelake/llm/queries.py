"""The corpus operators' queries and their SQL."""

from __future__ import annotations

from rulelake.llm.ann import op10_ann
from rulelake.llm.binswap import op12_best_fit
from rulelake.llm.common import QueryFn
from rulelake.llm.dac import op3_token_files
from rulelake.llm.embdedup import op2_embedding_dedup
from rulelake.llm.hardneg import op13_hard_negatives
from rulelake.llm.langid import op5_language_id
from rulelake.llm.lines import op9_line_dedup
from rulelake.llm.lmscore import op8_lm_scoring
from rulelake.llm.minhash import op4_minhash_dedup
from rulelake.llm.mixing import OP1_SQL, op1_mixing
from rulelake.llm.packing import op6_packing
from rulelake.llm.pii import op7_pii
from rulelake.llm.spelling import op11_spelling


def queries() -> dict[str, QueryFn]:
    return {
        "op1_mixing": op1_mixing,
        "op2_embedding_dedup": op2_embedding_dedup,
        "op3_token_files": op3_token_files,
        "op4_minhash_dedup": op4_minhash_dedup,
        "op5_language_id": op5_language_id,
        "op6_packing": op6_packing,
        "op7_pii": op7_pii,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_line_dedup": op9_line_dedup,
        "op10_ann": op10_ann,
        "op11_spelling": op11_spelling,
        "op12_best_fit": op12_best_fit,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": OP1_SQL.strip()}
