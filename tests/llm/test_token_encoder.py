"""The chunk cache of op3's encoder: ids are the library's, by its call that keeps no offsets."""

import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from clinical_cohort.llm.token_output import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a plain text of words", "", None, " lead and tail ", "two  spaces", "tab\tinside a word\t", "  odd  space x ",
         "line\nbreaks\n\nhere.", "ends in stops... and, commas", "<|endoftext|> said <|endoftext|>twice", "a<|endoftext|>b c", "x" * 50,
         "naïve café 中文", "a plain text again"]


class FastOnly:
    """A tokenizer without the calls that compute offsets."""

    def __init__(self, tokenizer):
        self.encode_batch_fast = tokenizer.encode_batch_fast


def test_ids_are_the_librarys_without_offsets():
    encoder, plain = Encoder(PATH), Tokenizer.from_file(PATH)
    encoder.tokenizer = FastOnly(plain)
    for _ in range(2):  # new chunks, then cached ones
        ids, lengths = encoder.encode(pa.array(TEXTS, pa.string()))
        want = [plain.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
        assert lengths.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_only_chunks_of_one_space_and_no_added_token_are_joined():
    joins = Encoder(PATH).joins
    assert all(joins(c) for c in (" a", " word", " a\tb", " café."))
    assert not any(joins(c) for c in ("", " ", "a", " a ", " a b", "  a", " \ta", " a\n", "  a", " <|endoftext|>", " x<|endoftext|>y"))
