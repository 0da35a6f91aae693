"""The registered queries of the text operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from voltline.llm import divergence, fill_middle, url_filter
from voltline.llm.divergence import op11_source_divergence
from voltline.llm.fill_middle import op12_fill_in_middle
from voltline.llm.fingerprints import op10_minhash_fingerprints
from voltline.llm.language_id import op5_language_id
from voltline.llm.lattice_pieces import op4_lattice_pieces
from voltline.llm.line_quality import op3_quality_classifier
from voltline.llm.packing import op9_packing
from voltline.llm.personal_data import op1_personal_data
from voltline.llm.quality_rules import op2_quality_rules
from voltline.llm.secret_scans import op7_secret_scans
from voltline.llm.set_join import op8_jaccard_join
from voltline.llm.toxicity import op13_toxicity
from voltline.llm.url_filter import op6_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_personal_data, op2_quality_rules, op3_quality_classifier, op4_lattice_pieces, op5_language_id, op6_url_filter, op7_secret_scans,
        op8_jaccard_join, op9_packing, op10_minhash_fingerprints, op11_source_divergence, op12_fill_in_middle, op13_toxicity,
    )
}
SQL = {"op6_url_filter": url_filter.oracle(), "op11_source_divergence": divergence.oracle(), "op12_fill_in_middle": fill_middle.oracle()}
