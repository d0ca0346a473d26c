"""Pre-tokens of the word-level BPE vocabulary, as its tokenizers file defines them."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

from tokenizers import Tokenizer

# What the vocabulary file declares as white space, contractions and special strings.
WHITE = "\t\n\x0b\x0c\r \x85\xa0"
CONTRACTIONS = "s t re ve m ll d"
SPECIAL = ["<|startoftext|>", "<|endoftext|>"]

# Below this code point normalising is lower-casing alone, so Python's own functions agree with the library.
FAST_LIMIT = 0x250
# Long texts are cut at white space, where no pre-token can span, into parts of about this many characters.
PART = 1 << 20


def _ranges(kind: str) -> str:
    return "".join(
        re.escape(chr(c)) for c in range(FAST_LIMIT) if unicodedata.category(chr(c))[0] == kind
    )


_LETTERS, _NUMBERS = _ranges("L"), _ranges("N")
_WORDS = re.compile(
    f"[{_LETTERS}]+|[{_NUMBERS}]|'(?:{CONTRACTIONS.replace(' ', '|')})|[^{re.escape(WHITE)}{_LETTERS}{_NUMBERS}]+"
)
_SIGNS = re.compile(f"[.,;:!?](?=[ \n])(?<=[{_LETTERS}{_NUMBERS}].)")
_BEYOND = re.compile(f"[^\x00-{chr(FAST_LIMIT - 1)}]")
_SPECIAL = re.compile("(" + "|".join(map(re.escape, SPECIAL)) + ")")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """The vocabulary file, read once per Python worker."""
    return Tokenizer.from_file(path)


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in pieces that end behind a blank or line end; a piece without one stays whole."""
    start = 0
    while len(text) - start > size:
        cut = max(text.rfind(" ", start, start + size), text.rfind("\n", start, start + size)) + 1
        if cut <= 0:
            blank = re.compile("[ \n]").search(text, start + size)
            cut = blank.end() if blank else len(text)
        yield text[start:cut]
        start = cut
    yield text[start:]


def _plain(path: str, text: str) -> list[str]:
    if not _BEYOND.search(text):
        return _WORDS.findall(text.lower())
    rules = tokenizer(path)
    return [word for word, _ in rules.pre_tokenizer[0].pre_tokenize_str(rules.normalizer.normalize_str(text))]


def spread(text: str) -> str:
    """The text with blanks between pre-tokens, where that is quick to tell: its pre-tokens stay the same.

    Letters are lower-cased and a sign between a letter or digit and a blank is set apart, so that a word is one
    string in most of its places.
    """
    if "<|" in text or _BEYOND.search(text):
        return text.replace("\n", " ")
    return _SIGNS.sub(r" \g<0>", text.lower()).replace("\n", " ")


def pretokens(path: str, text: str) -> list[str]:
    """Normalised pre-tokens in order; special strings stand as one item each, as written.

    No other item can equal a special string, as its letters and signs are split apart.
    """
    if "<|" not in text:
        return _plain(path, text)
    out: list[str] = []
    for index, piece in enumerate(_SPECIAL.split(text)):
        if index % 2:
            out.append(piece)
        elif piece:
            out += _plain(path, piece)
    return out


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 letters stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(rest)}


_LETTER_OF = _byte_letters()


def byte_level(word: str) -> str:
    """The word's UTF-8 bytes in the byte-level alphabet."""
    if word.isascii() and word.isalpha():
        return word
    return word.encode("utf-8").decode("latin-1").translate(_LETTER_OF)
