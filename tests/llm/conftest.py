import os
import random

import pytest

TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
DOC = "doc_id long, text string"


@pytest.fixture(scope="session")
def pieces_path():
    return f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="session")
def words_path():
    return f"{TOKENIZERS}/word_bpe_49k.json"


def prose(seed: int, n: int) -> list[str]:
    """Invented words, repeatable."""
    r = random.Random(seed)
    parts = ["ka", "lo", "mi", "ren", "so", "tu", "ve", "xi", "dor", "pa"]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n)]
