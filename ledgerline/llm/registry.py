"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from ledgerline.llm.ann import op7_ann
from ledgerline.llm.decontamination import op4_decontamination
from ledgerline.llm.langid import op3_langid
from ledgerline.llm.maxent_lm import op8_lm_scoring
from ledgerline.llm.merkle import op12_merkle
from ledgerline.llm.oracles import MANIFEST_SQL, TRIE_SQL
from ledgerline.llm.prefix_trie import op13_prefix_trie
from ledgerline.llm.secret_scan import op11_secrets
from ledgerline.llm.sentencepiece_codec import op1_sentencepiece
from ledgerline.llm.simhash import op6_simhash
from ledgerline.llm.substring_dedup import op10_substring_dedup
from ledgerline.llm.token_files import op9_token_files
from ledgerline.llm.toxicity import op2_toxicity
from ledgerline.llm.warc import op5_warc

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_toxicity": op2_toxicity,
    "op3_langid": op3_langid,
    "op4_decontamination": op4_decontamination,
    "op5_warc": op5_warc,
    "op6_simhash": op6_simhash,
    "op7_ann": op7_ann,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_token_files": op9_token_files,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_secrets": op11_secrets,
    "op12_merkle": op12_merkle,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {"op12_merkle": MANIFEST_SQL, "op13_prefix_trie": TRIE_SQL}
