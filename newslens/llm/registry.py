"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from newslens.llm import decontaminate, html_extract, jaccard_join, langid, lexical, lm_score, periodic, piece_codec, quality
from newslens.llm import secret_scan, token_files, topk, warc

QUERIES = {
    "op1_cover_tree": topk.op1,
    "op2_secret_scan": secret_scan.op2,
    "op3_token_files": token_files.op3,
    "op4_html_extract": html_extract.op4,
    "op5_quality": quality.op5,
    "op6_decontaminate": decontaminate.op6,
    "op7_warc": warc.op7,
    "op8_jaccard_join": jaccard_join.op8,
    "op9_piece_codec": piece_codec.op9,
    "op10_language": langid.op10,
    "op11_periodic_runs": periodic.op11,
    "op12_lexical_search": lexical.op12,
    "op13_lm_score": lm_score.op13,
}
SQL = {
    "op1_cover_tree": topk.OP1_SQL,
    "op6_decontaminate": decontaminate.OP6_SQL,
    "op7_warc": warc.OP7_SQL,
    "op8_jaccard_join": jaccard_join.OP8_SQL,
    "op12_lexical_search": lexical.OP12_SQL,
}
