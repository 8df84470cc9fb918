"""A byte-level tokenizer description usable offline.

Real runs pass the model's own ``tokenizer.json`` to ``JsonTokenizer``.  For
tests and examples this module builds a valid ``tokenizers`` JSON from a rule:
one id per byte (id = byte value, via the standard byte-to-printable-character
map of byte-level BPE) plus the chat markers as single special ids, so the
marker handling of the Python path is exercised without any download.
"""

from __future__ import annotations

from shardloom.functions.templates import BEGIN_OF_TEXT, END_HEADER, END_OF_TEXT, END_OF_TURN, START_HEADER

MARKERS = (BEGIN_OF_TEXT, START_HEADER, END_HEADER, END_OF_TURN, END_OF_TEXT)


def byte_to_char() -> dict[int, str]:
    """Printable bytes map to themselves; the others to 256, 257, ... in order."""
    keep = list(range(ord("!"), ord("~") + 1)) + list(range(0xA1, 0xAC + 1)) + list(range(0xAE, 0xFF + 1))
    out, extra = {}, 0
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


def byte_level_json(markers=MARKERS) -> str:
    from tokenizers import AddedToken, Tokenizer, decoders, models, pre_tokenizers

    vocab = {ch: b for b, ch in byte_to_char().items()}
    tok = Tokenizer(models.BPE(vocab=vocab, merges=[]))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    tok.decoder = decoders.ByteLevel()
    tok.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in markers])
    return tok.to_str()
