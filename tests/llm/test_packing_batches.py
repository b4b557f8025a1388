"""A batch's distinct words are looked up once, and ids are those of the tokenizer whatever the letters."""

from tapelake.llm import packing
from tapelake.llm.queries import tokenizer

TEXTS = [None, "", " ", "\n\n a\tb\x0bc\x0cd\re  f.\n", "É. é, Straße, ß. İx, Ab", "x\x00y \x85 q", "<|endoftext|> don't. 1,2", "Ångström ångström, ÉCOLE école. 東京 Ωσ"]


def test_ids_of_a_batch_are_those_of_its_texts():
    words = packing.WordIds(tokenizer("word_bpe_49k.json"), 5)
    want = [words._each([text or ""])[0] for text in TEXTS]
    for _ in range(3):  # also when words come from the old generation
        assert words.encode([text if text is None else text.encode() for text in TEXTS]) == want
    assert words.encode([]) == []


def test_distinct_words_are_looked_up_once_a_batch():
    words, seen = packing.WordIds(tokenizer("word_bpe_49k.json")), []

    class Seen(dict):
        def __getitem__(self, word):
            seen.append(word)
            return dict.__getitem__(self, word)

    words.known.now = Seen()
    words.encode([b"one two one", b"two\tone one"] * 50)
    assert sorted(seen) == [b"one", b"two"]


def test_latin_letters_get_the_tokenizers_ids():
    words = packing.WordIds(tokenizer("word_bpe_49k.json"))
    letters = [c for c in map(chr, range(0x41, 0x260)) if c.isalpha()]
    texts = letters + ["".join(letters[i : i + 7]) for i in range(0, len(letters), 5)]
    assert words.encode([text.encode() for text in texts]) == words._each(texts)
