"""Parameters of the registered queries."""

from __future__ import annotations

import os

from .host_reputation import Rule
from .mixing import Weights

#: Web sources, reference works and dialogue, by the sources' names.
DOMAIN_WEIGHTS = Weights(
    domains={
        **{f"src{k}": "web" for k in range(0, 10)},
        **{f"src{k}": "reference" for k in range(10, 16)},
        **{f"src{k}": "dialogue" for k in range(16, 20)},
    },
    domain={"web": 5, "reference": 4, "dialogue": 2},
    lang={"en": 6, "de": 3, "fr": 3, "es": 2},
    source={"src0": 3, "src10": 2},
)

URL_RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)

#: Where the files of public tokenizers are.
TOKENIZERS = os.environ.get("REVPULSE_TOKENIZERS", "/opt/tokenizers")
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
BYTE_VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
BYTE_VOCABULARY_JSON = f"{TOKENIZERS}/byte_bpe_50k.json"
WORD_VOCABULARY_JSON = f"{TOKENIZERS}/word_bpe_49k.json"
#: Fixed value: the public pattern that cuts texts for this vocabulary.
TOKEN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
