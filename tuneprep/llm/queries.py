"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from tuneprep.llm import (
    caps,
    centroids,
    chat,
    langid,
    licences,
    mixing,
    mtree,
    ngram_lm,
    phrases,
    pieces,
    secret_scan,
    simhash,
    url_filter,
)

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_simhash": simhash.op2_simhash,
    "op3_licences": licences.op3_licences,
    "op4_ngram_lm": ngram_lm.op4_ngram_lm,
    "op5_mtree": mtree.op5_mtree,
    "op6_caps": caps.op6_caps,
    "op7_chat": chat.op7_chat,
    "op8_mixing": mixing.op8_mixing,
    "op9_secrets": secret_scan.op9_secrets,
    "op10_langid": langid.op10_langid,
    "op11_centroids": centroids.op11_centroids,
    "op12_urls": url_filter.op12_urls,
    "op13_phrases": phrases.op13_phrases,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op5_mtree": mtree.OP5_SQL,
    "op6_caps": caps.OP6_SQL,
    "op7_chat": chat.OP7_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op11_centroids": centroids.OP11_SQL,
    "op13_phrases": phrases.OP13_SQL,
}
