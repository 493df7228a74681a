"""The dealt queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from cohortlens.llm import hash_tree, licenses, merkle, spelling
from cohortlens.llm.cross_polytope import op7_nearest
from cohortlens.llm.jaccard_join import op2_jaccard_join
from cohortlens.llm.language_id import op3_language_id
from cohortlens.llm.mixing import op5_mixing
from cohortlens.llm.packing import op1_packing
from cohortlens.llm.quality_rules import op4_quality_rules
from cohortlens.llm.suffix_dedup import op10_suffix_dedup
from cohortlens.llm.token_output import op9_token_output
from cohortlens.llm.toxicity import op6_toxicity

QUERIES = {f.__name__: f for f in (op1_packing, op2_jaccard_join, op3_language_id, op4_quality_rules,
                                    op5_mixing, op6_toxicity, op7_nearest,
                                    licenses.op8_license_scan, op9_token_output, op10_suffix_dedup,
                                    spelling.op11_spelling, merkle.op12_merkle_manifest, hash_tree.op13_sharding)}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op8_license_scan": licenses.oracle(), "op11_spelling": spelling.oracle(), "op12_merkle_manifest": merkle.oracle(),
            "op13_sharding": hash_tree.oracle()}
