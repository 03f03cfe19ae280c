"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from lendspark.llm.decontaminate import op1_decontaminate
from lendspark.llm.jaccard_join import op5_jaccard_join
from lendspark.llm.lattice_lm import op10_lattice_likelihood
from lendspark.llm.licenses import op2_license_scan
from lendspark.llm.line_dedup import op3_line_dedup
from lendspark.llm.negatives import OP11_SQL, op11_hard_negatives
from lendspark.llm.packing import op4_concat_and_cut
from lendspark.llm.periodic import op12_periodic_runs
from lendspark.llm.pii import op7_surrogates
from lendspark.llm.quality import op6_adaptive_quality
from lendspark.llm.sharding import op8_differencing_shards
from lendspark.llm.toxicity import op9_toxicity_bigru
from lendspark.llm.url_templates import OP13_SQL, op13_url_templates

QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_license_scan,
        op3_line_dedup,
        op4_concat_and_cut,
        op5_jaccard_join,
        op6_adaptive_quality,
        op7_surrogates,
        op8_differencing_shards,
        op9_toxicity_bigru,
        op10_lattice_likelihood,
        op11_hard_negatives,
        op12_periodic_runs,
        op13_url_templates,
    )
} | {"pipeline": corpus_pipeline.run}
ORACLES: dict[str, str] = {"op11_hard_negatives": OP11_SQL, "op13_url_templates": OP13_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
