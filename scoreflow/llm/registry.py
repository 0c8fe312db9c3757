"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import (decontamination, language_id, multi_index, pii, prefix_trie, secret_scan, sentencepiece_viterbi, simhash,
               syncmer, token_counts, toxicity, url_reputation, warc_zip)

QUERIES = {
    "op1_host_reputation": url_reputation.op1_host_reputation,
    "op2_language_id": language_id.op2_language_id,
    "op3_simhash": simhash.op3_simhash,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_sentencepiece": sentencepiece_viterbi.op5_sentencepiece,
    "op6_warc_zip": warc_zip.op6_warc_zip,
    "op7_secret_scan": secret_scan.op7_secret_scan,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_syncmer": syncmer.op9_syncmer,
    "op10_pii": pii.op10_pii,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_multi_index": multi_index.op12_multi_index,
    "op13_toxicity": toxicity.op13_toxicity,
}

ORACLE = {
    "op1_host_reputation": url_reputation.ORACLE,
    "op4_decontamination": decontamination.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_multi_index": multi_index.ORACLE,
}
