"""Queries of the operators on the driver's tables, and the SQL of those that SQL can express."""

from tillrecon.llm.mixing import op6_mixing
from tillrecon.llm.hamming_index import op5_hamming
from tillrecon.llm.histogram_sharding import op13_sharding
from tillrecon.llm.license_scan import OP7_SQL, op7_licenses
from tillrecon.llm.near_dup import OP10_SQL, op10_minhash
from tillrecon.llm.quality_rules import op3_quality
from tillrecon.llm.sentencepiece_sampling import op2_sentencepiece
from tillrecon.llm.source_divergence import OP11_SQL, op11_divergence
from tillrecon.llm.substring_dedup import OP1_SQL, op1_substring
from tillrecon.llm.suffix_dedup import op4_suffix
from tillrecon.llm.url_filters import OP9_SQL, op9_urls
from tillrecon.llm.vector_codes import OP12_SQL, op12_codes
from tillrecon.llm.warc import OP8_SQL, op8_warc

QUERIES = {
    "op4_suffix": op4_suffix,
    "op5_hamming": op5_hamming,
    "op8_warc": op8_warc,
    "op7_licenses": op7_licenses,
    "op9_urls": op9_urls,
    "op2_sentencepiece": op2_sentencepiece,
    "op6_mixing": op6_mixing,
    "op3_quality": op3_quality,
    "op1_substring": op1_substring,
    "op10_minhash": op10_minhash,
    "op11_divergence": op11_divergence,
    "op12_codes": op12_codes,
    "op13_sharding": op13_sharding,
}

ORACLES = {
    "op7_licenses": OP7_SQL,
    "op8_warc": OP8_SQL,
    "op9_urls": OP9_SQL,
    "op1_substring": OP1_SQL,
    "op10_minhash": OP10_SQL,
    "op11_divergence": OP11_SQL,
    "op12_codes": OP12_SQL,
}
