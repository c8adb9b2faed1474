"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from gleanspark.llm.alignment import op11
from gleanspark.llm.ann import op4
from gleanspark.llm.bpe import op8
from gleanspark.llm.chat import OP1_SQL, op1
from gleanspark.llm.exact_dedup import OP7_SQL, op7
from gleanspark.llm.importance import OP13_SQL, op13
from gleanspark.llm.lm import op9
from gleanspark.llm.minhash import OP12_SQL, op12
from gleanspark.llm.mixing import OP5_SQL, op5
from gleanspark.llm.secrets import op10
from gleanspark.llm.simhash import op6
from gleanspark.llm.token_files import op3
from gleanspark.llm.toxicity import op2

QUERIES = {
    "op1_chat_format": op1, "op2_toxicity": op2, "op3_token_files": op3, "op4_nearest_neighbours": op4, "op5_mixing": op5, "op6_simhash": op6,
    "op7_exact_dedup": op7, "op8_bpe": op8, "op9_lm_scores": op9, "op10_secrets": op10,
    "op11_alignment": op11, "op12_minhash": op12, "op13_importance": op13,
}

SQL = {"op1_chat_format": OP1_SQL, "op5_mixing": OP5_SQL, "op7_exact_dedup": OP7_SQL, "op12_minhash": OP12_SQL, "op13_importance": OP13_SQL}
