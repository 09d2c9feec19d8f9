import pytest

from fieldgauge.llm.tokens import vocabulary


@pytest.fixture(scope="session")
def vocab():
    return vocabulary("word_bpe_49k.json")
