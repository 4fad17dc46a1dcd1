import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsegrid.llm.chunks import ByteLevelCoder, PieceCoder, WordEndCoder

PARTS = ["a", "Zz", "\u00e9", "e\u0301", "\u00df", "\u0130", "\u03a3\u0391\u03a3", "\u00b4", "\u0301", " ", "  ", "   ", "\n", "\r", "\r\n", "\t", "\x0b",
         "\x1c", "\x85", "\u00a0", "\u1680", "\u180e", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", ".", ",", "...", "'", "'s", "'ll", "'d'", "_",
         "1", "23", "\u00bd", "\u00d7", "\u00f7", ";\r", "{\r", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "<s>", "<unk>", "<0x41>", "\u2581",
         "\u6f22", "\ud55c", "\U0001f600", "\x00", "\x7f", "\ufeff", "word", "Word", "the", "http://x.y", "\u00aa", "\u00ba", "\u00c0\u00d6", "\u0130s"]
texts = st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=6)


def coded(coder, rows):
    return [ids[a:b].tolist() for _, ids, at in coder.rows(pa.array(rows, pa.large_string())) for a, b in zip(at, at[1:], strict=False)]


@pytest.fixture(scope="module")
def models():
    byte, word, piece = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
    plain = Tokenizer.from_file(byte)
    plain.encode_special_tokens = True
    return [(ByteLevelCoder(byte), Tokenizer.from_file(byte)), (ByteLevelCoder(byte, True), plain), (WordEndCoder(word), Tokenizer.from_file(word))], \
        (PieceCoder(piece), sentencepiece.SentencePieceProcessor(model_file=piece))


@settings(max_examples=400, deadline=None)
@given(texts)
def test_ids_are_those_of_the_whole_texts(models, rows):
    for coder, tok in models[0]:
        assert coded(coder, rows) == [e.ids for e in tok.encode_batch_fast(rows, add_special_tokens=False)]
    coder, model = models[1]
    full = [r for r in rows if r]  # the library adds no space to an empty text
    assert coded(coder, [" " + r for r in full]) == model.encode(full)


def test_memory_of_chunks_ages(models, monkeypatch):
    monkeypatch.setattr("pulsegrid.llm.chunks.MEMORY_CHUNKS", 3)
    coder, tok = models[0][0]
    rows = ["one two three", "four five", None, "", "one six two", "x" * 50_000, "one two three"]
    for _ in range(3):
        got = [ids[a:b].tolist() for _, ids, at in coder.rows(pa.array(rows), 8) for a, b in zip(at, at[1:], strict=False)]
        assert got == [tok.encode(r or "", add_special_tokens=False).ids for r in rows]


def test_tables_spell_the_text(models):
    text = " naïve 漢字\tx\x01 \U0001f600"
    for coder in (models[0][0][0], models[1][0]):
        ids = coded(coder, [text])[0]
        assert b"".join(coder.table[i] for i in ids) == text.encode()
        assert [len(coder.table[i]) for i in ids] == coder.lengths[ids].tolist()
