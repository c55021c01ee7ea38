"""Only letters make words, and texts without any have no language."""

from tabloom.llm.language import WordModel, words_in


def test_all_characters():
    for c in map(chr, range(0x110000)):
        if not "\ud800" <= c <= "\udfff":
            wanted = [w for w in "".join(x if x.isalpha() else " " for x in c.lower()).split()]
            assert words_in(c) == wanted, hex(ord(c))


def test_mixed_words():
    assert words_in("Ab½cd ① x²y Ⅷ no_t 3rd") == ["ab", "cd", "x", "y", "no", "t", "rd"]
    assert words_in(None) == words_in("") == words_in("½ ² ①") == []


def test_numerals_have_no_language():
    model = WordModel(["de", "en"], {n: {} for n in range(6)}, (0.0, 0.0))
    assert model.predict("½ ² ①") == ("und", 0.0) and model.predict("a ½")[0] == "de"
