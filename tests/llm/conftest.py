import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer


@pytest.fixture(scope="session")
def awkward():
    """Texts that are null, empty, blank, long, repeated, or full of marks and white space."""
    return [
        None, "", " ", "\n", "a", "Two words", "a\n\nb", " a ", "a  b", "a\tb", "don't WE'll it's 123 4a5 x' 's",
        "<|endoftext|>", "a <|endoftext|> b<|ENDoftext|>", "ééé Ñ 漢字 😀 ́x é İx ΣΑΣ ﬁ", "a​b c", "x" * 3000,
        "aÉ\n" * 50, "it\n's", "a\x85b", "a b　c", "\x1cq\x1fz", "abc--- ab' ab's. ab'.'s", "ß÷x", "word " * 4000,
        "Two words", "Two words",
    ]


@pytest.fixture(scope="session")
def texts_frame(spark, awkward):
    """``awkward`` as documents, with null and repeated ids and columns whose names clash."""
    rows = [(None if i == 5 else 7 if i in (8, 9, 24, 25) else i, t, 1, "k") for i, t in enumerate(awkward)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, bucket string")


@pytest.fixture(scope="session")
def no_texts(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def byte_file():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_file():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def word_ids(word_file):
    library = Tokenizer.from_file(word_file)
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


@pytest.fixture
def rng():
    return random.Random(5)
