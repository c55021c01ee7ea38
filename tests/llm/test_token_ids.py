import random

import duckdb

from tabloom.llm.token_ids import default_path, encoder, packed


def test_ids_equal_the_library(sf):
    own = encoder(default_path())
    texts = [r[0] for r in duckdb.sql(f"select text from '{sf}/documents.parquet'").fetchall()]
    parts = [" ", "  ", "\n", "\t", "\n\n", "'s", "'t", "a", "the", "É", "ß", "1", "½", "²", "!", "...", " ",
             "　", "\x1c", "\x85", "🙂", "_", "日本", "'ll", "'", "<|endoftext|>", "\r\n"]
    rng = random.Random(1)
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for text in texts:
        assert own.encode(text) == packed(own.tokenizer.encode(text, add_special_tokens=False).ids)


def test_null_and_empty():
    assert encoder(default_path()).encode(None) == b"" == encoder(default_path()).encode("")


def test_many_together_equal_one_by_one(sf):
    """Lots of any size, down to one that cuts every text at every seam."""
    own = encoder(default_path())
    texts = [r[0] for r in duckdb.sql(f"select text from '{sf}/documents.parquet' limit 300").fetchall()]
    parts = [" ", "  ", "\n", "\t", "\n\n", "\r\n", "\x00", "\x1c", "\x85", "\u00a0", "\u3000", "'s", "'", "a", "the", "É", "½", "...", "🙂",
             "日本", "<|endoftext|>", "x y", "word\nword"]
    rng = random.Random(2)
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    texts += [None, "", "a b " * 50_000, "x" * 100_000, " ", "\n"]
    wanted = [packed(own.tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    for lot in (1, 100, 1 << 22):
        assert list(own.encode_all(texts, lot)) == wanted
    assert list(own.encode_all([])) == []


def test_white_space_of_the_pattern():
    """Every character that the pattern takes for white space keeps a text from the plain way."""
    import regex

    from tabloom.llm.token_ids import MIXED

    spaces = {c for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff" and regex.match(r"\s", c)}
    assert spaces <= {" ", "\n", *MIXED}


def test_memories_of_different_size_give_the_same_ids():
    """The token store remembers more chunks than packing: each asks for an encoder of its own."""
    large, small = encoder(default_path(), 500_000), encoder(default_path(), 2)
    assert large is not small and (large.kept_chunks, small.kept_chunks) == (500_000, 2)
    texts = ["one two three two one", "", "four five one"]
    assert list(large.encode_all(texts)) == list(small.encode_all(texts)) == [small.encode(t) for t in texts]
