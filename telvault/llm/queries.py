"""The registered queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

from telvault.llm import pipeline
from telvault.llm.bpe import op2_bpe
from telvault.llm.chat import op8_chat
from telvault.llm.decontamination import op9_decontamination
from telvault.llm.langid import op5_langid
from telvault.llm.linededup import op12_line_dedup
from telvault.llm.negatives import op13_hard_negatives
from telvault.llm.quality_classifier import op10_quality_classifier
from telvault.llm.quality_rules import op6_quality_rules
from telvault.llm.resampling import op11_resampling
from telvault.llm.sharding import op3_sharding
from telvault.llm.simhash import op7_simhash
from telvault.llm.toxicity import op4_toxicity
from telvault.llm.warc import op1_warc

QUERIES = {f.__name__: f for f in (
    op1_warc, op2_bpe, op3_sharding, op4_toxicity, op5_langid, op6_quality_rules, op7_simhash, op8_chat,
    op9_decontamination, op10_quality_classifier, op11_resampling, op12_line_dedup, op13_hard_negatives)} | {"pipeline": pipeline.run}
