"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from .bpe import op9_bpe_encode_decode
from .embedding_dedup import op6_embedding_near_dedup
from .exact_dedup import OP4_SQL, op4_exact_dedup
from .html_extract import op7_html_extraction
from .merkle import OP11_SQL, op11_merkle_manifest
from .near_dedup import op5_minhash_near_dedup
from .packing import op2_best_fit_packing
from .quality import op8_quality_classifier
from .resampling import OP12_SQL, op12_importance_resampling
from .substrings import op3_substring_dedup
from .suffixes import OP13_SQL, op13_suffix_array_dedup
from .token_counts import op10_token_counts
from .token_files import op1_token_files

QUERIES = {f.__name__: f for f in (op1_token_files, op2_best_fit_packing, op3_substring_dedup, op4_exact_dedup, op5_minhash_near_dedup, op6_embedding_near_dedup, op7_html_extraction, op8_quality_classifier, op9_bpe_encode_decode, op10_token_counts, op11_merkle_manifest, op12_importance_resampling, op13_suffix_array_dedup)}
ORACLE_SQL = {"op4_exact_dedup": OP4_SQL, "op11_merkle_manifest": OP11_SQL, "op12_importance_resampling": OP12_SQL, "op13_suffix_array_dedup": OP13_SQL}
