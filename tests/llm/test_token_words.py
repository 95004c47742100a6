import random

import numpy as np
import public_tokenizers
import pyarrow as pa

from loomspark.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rng = random.Random(4)
    words = ["Word", "a", "don't", "x1,", "(b)", "naïve.", "日本", "é", "3.14", "l'été", "_", "Ġ", "end!?"]
    gaps = [" "] * 30 + ["\n"] * 6 + ["  ", "\n\n", " \n", "\n ", "\t", "\r\n", " ", " ", "\x1c", "\x85"]
    made = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    return made + [t.strip() for t in made] + ["", " ", "\n", "\na", "a\n", " a", "a ", "a\n\nb", "a \nb", "a\n b", "\n\na"]


def test_words_give_the_ids_of_whole_texts():
    encoder = token_files.WordEncoder(PATH)
    some = texts() + [f"a {encoder.added[0]} b"]
    assert encoder.by_words
    for _ in range(2):
        got = [np.frombuffer(x, encoder.type).tolist() for x in encoder.encode(some)]
        assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def test_words_met_before_are_only_looked_up(monkeypatch):
    encoder = token_files.WordEncoder(PATH)
    some = ["One word, and (more) of them.\nOne line, then another!"]
    first = encoder.encode(some)
    monkeypatch.setattr(token_files, "_STEM", None)
    monkeypatch.setattr(encoder, "_ids", lambda new: [] if not new else 1 / 0)
    assert encoder.encode(some) == first


def test_words_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT", 50)
    encoder = token_files.WordEncoder(PATH)
    some = texts()
    for at in range(0, len(some), 100):
        part = some[at : at + 100]
        got = [np.frombuffer(x, encoder.type).tolist() for x in encoder.encode(part)]
        assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in part]


class OnlyLookedUp(dict):
    def __iter__(self):
        raise AssertionError("a piece goes through all words kept")


def test_a_piece_costs_no_walk_through_all_words_kept():
    encoder = token_files.WordEncoder(PATH)
    encoder.words = OnlyLookedUp()
    for some in (["One word, (more) of them."], ["One other word.\nAnd more, then another!"], texts()):
        got = [np.frombuffer(x, encoder.type).tolist() for x in encoder.encode(some)]
        assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def test_arrow_texts_with_nulls_slices_and_only_whole_ones():
    encoder = token_files.WordEncoder(PATH)
    some = [None, "a  b", *texts()[:300], None, "Łódź, é!x ’tis 'tis (l'été)... don't? x\u200by", "", "a\u3000b"]
    want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in some]
    for a, b in ((0, len(some)), (0, 1), (0, 2), (1, 2), (2, 7), (150, 310), (0, 0)):
        got = encoder.encode(pa.array(some, pa.string()).slice(a, b - a))
        assert [np.frombuffer(x, encoder.type).tolist() for x in got] == want[a:b]
