"""Token ids of whole texts with a published vocabulary file.

``encoder(path)`` gives a function from texts to ids. Words are cut at the six
ASCII white space characters, at which the vocabulary's own pre-tokenizer cuts
too, and words are kept with their ids in a bounded table of the Python worker: of
two halves the older one goes when the younger one is full, and a word that is
met again moves to the younger, so frequent words stay when rare ones fill the table. A word of Latin letters with plain punctuation after it goes
straight to the vocabulary's merges; any other word goes through the whole
published pipeline, so the ids are those of encoding the text at once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache
from struct import pack

DEFAULT_FILE = "word_bpe_49k.json"
TABLE_SIZE = 150_000
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|%&$#*]*)\Z")


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the rest for 256, 257, ..."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def encoder(path: str | None = None) -> Callable[[list[bytes]], list[bytes]]:
    """From UTF-8 texts to little-endian unsigned 16-bit ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(DEFAULT_FILE)
    tok = Tokenizer.from_file(path)
    if tok.get_vocab_size() >= 1 << 16:
        raise ValueError("the vocabulary does not fit 16-bit ids")
    model, letters = tok.model, byte_letters()
    latin = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
    pieces: dict[str, bytes] = {}
    older_pieces: dict[str, bytes] = {}
    table: dict[bytes, bytes] = {}
    older: dict[bytes, bytes] = {}

    two = [pack("<H", i) for i in range(tok.get_vocab_size())]

    def piece(text: str) -> bytes:
        nonlocal pieces, older_pieces
        found = pieces.get(text)
        if found is None:
            found = older_pieces.get(text)
            if found is None:
                found = b"".join([two[t.id] for t in model.tokenize(text if text.isascii() else text.translate(latin))])
            if len(pieces) >= TABLE_SIZE // 2:
                pieces, older_pieces = {}, pieces
            pieces[text] = found
        return found

    def word(raw: bytes) -> bytes:
        if raw.isalpha():  # ASCII letters alone
            return piece(raw.lower().decode())
        text = raw.decode("utf-8", "replace")
        plain = PLAIN.match(text)
        if plain is None:
            return b"".join([two[i] for i in tok.encode(text, add_special_tokens=False).ids])
        head, tail = plain.groups()
        return piece(head.lower()) + (piece(tail) if tail else b"")

    def encode(texts: list[bytes]) -> list[bytes]:
        nonlocal table, older
        out = []
        for t in texts:
            words = t.split()
            missing = set(words).difference(table)
            if len(table) + len(missing) > TABLE_SIZE // 2:
                table, older = {}, table
                missing = set(words)
            for w in missing:
                table[w] = older.get(w) or word(w)
            out.append(b"".join([table[w] for w in words]))
        return out

    return encode
