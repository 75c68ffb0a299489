"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from cellkpi.llm.byte_bpe import op3_byte_bpe
from cellkpi.llm.chat_format import OP4_SQL, op4_chat_format
from cellkpi.llm.decontaminate import op10_decontaminate
from cellkpi.llm.filter_audit import OP11_SQL, op11_filter_audit
from cellkpi.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from cellkpi.llm.katz import op13_katz
from cellkpi.llm.language_id import op9_language_id
from cellkpi.llm.line_dedup import OP1_SQL, op1_line_dedup
from cellkpi.llm.near_dup import OP8_SQL, op8_near_dup
from cellkpi.llm.pii import op2_pii
from cellkpi.llm.sharding import op7_sharding
from cellkpi.llm.topk_search import OP6_SQL, op6_topk_search
from cellkpi.llm.toxicity import op5_toxicity

Q = {
    "op1_line_dedup": op1_line_dedup,
    "op2_pii": op2_pii,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_chat_format": op4_chat_format,
    "op5_toxicity": op5_toxicity,
    "op6_topk_search": op6_topk_search,
    "op7_sharding": op7_sharding,
    "op8_near_dup": op8_near_dup,
    "op9_language_id": op9_language_id,
    "op10_decontaminate": op10_decontaminate,
    "op11_filter_audit": op11_filter_audit,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_katz": op13_katz,
}

SQL = {
    "op1_line_dedup": OP1_SQL,
    "op4_chat_format": OP4_SQL,
    "op6_topk_search": OP6_SQL,
    "op8_near_dup": OP8_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
