"""Named queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from docsift.llm import centroids, fim, quality_rules, secrets
from docsift.llm.bpe import op2_bpe_round_trip
from docsift.llm.centroids import op12_centroids
from docsift.llm.fim import op11_fill_in_middle
from docsift.llm.idfiles import op8_huffman_ids
from docsift.llm.jaccard_join import op6_jaccard_join
from docsift.llm.licenses import op5_license_scan
from docsift.llm.mixing import op4_mix_sources
from docsift.llm.pieces import op13_sentencepiece
from docsift.llm.quality_model import op9_quality_model
from docsift.llm.quality_rules import op10_quality_rules
from docsift.llm.secrets import op3_secret_scan
from docsift.llm.simhash import op7_simhash
from docsift.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_secret_scan": op3_secret_scan,
    "op4_mix_sources": op4_mix_sources,
    "op5_license_scan": op5_license_scan,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_simhash": op7_simhash,
    "op8_huffman_ids": op8_huffman_ids,
    "op9_quality_model": op9_quality_model,
    "op10_quality_rules": op10_quality_rules,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_centroids": op12_centroids,
    "op13_sentencepiece": op13_sentencepiece,
}

#: DuckDB SQL of the queries that SQL can express
ORACLE: dict[str, str] = {
    "op3_secret_scan": secrets.oracle(),
    "op10_quality_rules": quality_rules.oracle(),
    "op11_fill_in_middle": fim.oracle(),
    "op12_centroids": centroids.oracle(),
}
