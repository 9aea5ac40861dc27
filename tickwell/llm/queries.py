"""Queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from tickwell.llm.bpe import op3
from tickwell.llm.chat import OP4_SQL, op4
from tickwell.llm.decontaminate import OP6_SQL, op6
from tickwell.llm.fingerprints import op11
from tickwell.llm.language_model import op7
from tickwell.llm.pages import op9
from tickwell.llm.quality import op5
from tickwell.llm.secrets import op2
from tickwell.llm.simhash import op10
from tickwell.llm.spellings import op13
from tickwell.llm.suffixes import op1
from tickwell.llm.toxicity import op8
from tickwell.llm.whitening import op12

QUERIES = {
    "op1_suffixes": op1,
    "op2_secrets": op2,
    "op3_bpe": op3,
    "op4_preferences": op4,
    "op5_quality": op5,
    "op6_decontamination": op6,
    "op7_language_model": op7,
    "op8_toxicity": op8,
    "op9_main_text": op9,
    "op10_simhash": op10,
    "op11_fingerprints": op11,
    "op12_whitening": op12,
    "op13_spellings": op13,
}

ORACLE = {"op4_preferences": OP4_SQL, "op6_decontamination": OP6_SQL}
