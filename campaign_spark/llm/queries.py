"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from .ann import op7_nearest_neighbours
from .divergence import OP12_SQL, op12_source_divergence
from .fill_middle import OP13_SQL, op13_fill_in_middle
from .html_text import op1_html_extraction
from .licences import OP3_SQL, op3_license_scan
from .mixing import op4_mixing_sources
from .mixing_lm import op2_lm_scoring
from .near_dup import op9_minhash_near_dedup
from .packing import op8_best_fit_packing
from .personal import op11_personal_data
from .quality import OP6_SQL, op6_quality_rules
from .quality_model import op10_quality_classifier
from .suffix_dedup import op5_suffix_array_dedup

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_license_scan": op3_license_scan,
    "op4_mixing_sources": op4_mixing_sources,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_personal_data": op11_personal_data,
    "op12_source_divergence": op12_source_divergence,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLE = {"op3_license_scan": OP3_SQL, "op6_quality_rules": OP6_SQL, "op12_source_divergence": OP12_SQL,
          "op13_fill_in_middle": OP13_SQL}
