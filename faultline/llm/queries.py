"""The registered queries of the operators, one per operator."""

from __future__ import annotations

from faultline.llm import (chat_paths, collocations, decontaminate, fingerprints, fixity, jaccard_join, language_id, licenses, line_dedup,
                           near_vectors, packing, toxicity, whitening)

QUERIES = {
    "op1_licenses": licenses.query,
    "op2_chat_paths": chat_paths.query,
    "op3_line_dedup": line_dedup.query,
    "op4_toxicity": toxicity.query,
    "op5_near_vectors": near_vectors.query,
    "op6_packing": packing.query,
    "op7_decontaminate": decontaminate.query,
    "op8_fixity": fixity.query,
    "op9_language_id": language_id.query,
    "op10_jaccard_join": jaccard_join.query,
    "op11_collocations": collocations.query,
    "op12_fingerprints": fingerprints.query,
    "op13_whitening": whitening.query,
}
ORACLES: dict[str, str] = {
    "op2_chat_paths": chat_paths.ORACLE,
    "op8_fixity": fixity.ORACLE,
    "op11_collocations": collocations.ORACLE,
}
