"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import decontam, html_text, jaccard, langid, line_dedup, mixing, pii, secrets, vectors, warc

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_html_text": html_text.op2_html_text,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_decontaminate": decontam.op4_decontaminate,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_personal_data": pii.op6_personal_data,
    "op7_warc_round_trip": warc.op7_warc_round_trip,
    "op8_near_vectors": vectors.op8_near_vectors,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_language_id": langid.op10_language_id,
}

ORACLES = {
    "op4_decontaminate": decontam.SQL,
    "op5_jaccard_join": jaccard.SQL,
    "op7_warc_round_trip": warc.SQL,
    "op8_near_vectors": vectors.SQL,
    "op9_line_dedup": line_dedup.SQL,
}
