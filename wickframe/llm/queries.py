"""Registered queries of the training-data operators."""

from __future__ import annotations

from wickframe.llm import collocations, embedding_dedup, sharding, url_filter
from wickframe.llm.byte_bpe import op5_byte_bpe
from wickframe.llm.collocations import op11_collocations
from wickframe.llm.embedding_dedup import op1_embedding_dedup
from wickframe.llm.language import op10_language
from wickframe.llm.packing import op7_packing
from wickframe.llm.pair_bpe import op13_pair_bpe
from wickframe.llm.periodic_runs import op12_periodic_runs
from wickframe.llm.sharding import op9_sharding
from wickframe.llm.simhash import op4_simhash
from wickframe.llm.toxicity import op2_toxicity
from wickframe.llm.url_filter import op6_url_filter
from wickframe.llm.warc import op8_warc
from wickframe.llm.winnowing import op3_winnowing

QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_winnowing": op3_winnowing,
    "op4_simhash": op4_simhash,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_url_filter": op6_url_filter,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_sharding": op9_sharding,
    "op10_language": op10_language,
    "op11_collocations": op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_pair_bpe": op13_pair_bpe,
}
SQL: dict[str, str] = {**embedding_dedup.SQL, **url_filter.SQL, **sharding.SQL, **collocations.SQL}
