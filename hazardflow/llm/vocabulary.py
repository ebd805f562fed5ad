"""A subword vocabulary read from a model file: pieces, log scores, byte pieces."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

#: Where the public vocabulary lies unless the caller names another file.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a space in pieces
LITERAL = "\udc81"  # stands for that character itself in a text: a code no valid text holds


@dataclass
class Vocabulary:
    """Pieces by text, their ids and natural log scores; byte pieces for all else.

    `cuts` says that no piece goes on over a space mark after another character or over a line
    end, so every segmentation breaks there."""

    ids: dict[str, int]
    logs: list[float]
    byte_ids: list[int]
    texts: list[bytes | None]
    longest: int
    cuts: bool
    _split: re.Pattern = field(default=re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+"), repr=False)

    def mark(self, text: str) -> str:
        """The text as pieces see it: a mark in front and for each space."""
        return MARK + text.replace(MARK, LITERAL).replace(" ", MARK)

    def parts(self, marked: str) -> list[str]:
        """Parts that no piece crosses."""
        return self._split.findall(marked) if self.cuts else [marked]

    def fallback(self, char: str) -> list[int]:
        """Byte pieces of a character without a piece of its own."""
        return [self.byte_ids[b] for b in (MARK if char == LITERAL else char).encode()]

    def decode(self, ids) -> str:
        """The text that was encoded; pieces without a text (control pieces) are left out."""
        out = b"".join([t for t in (self.texts[i] for i in ids) if t is not None])
        return (out[1:] if out[:1] == b" " else out).decode()


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read on the driver and shipped inside tasks: a vocabulary is bounded, some 32,000 pieces.

    Scores of a unigram model are log probabilities and taken as they are. A merge model scores a
    piece by minus its rank; by Zipf's law its log probability is -ln(rank + 2.7) less a constant.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    ids, logs, texts, byte_ids = {}, [float("-inf")] * size, [None] * size, [0] * 256
    scores = {}
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
            texts[i] = bytes([int(piece[3:-1], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ids[piece] = i
            texts[i] = piece.replace(MARK, " ").encode()
            scores[i] = model.get_score(i)
    if min(scores.values()) < -1000:
        order = {i: r for r, i in enumerate(sorted(scores, key=lambda i: (-scores[i], i)))}
        weights = {i: 1 / (r + 2.7) for i, r in order.items()}
        total = sum(weights.values())
        scores = {i: math.log(w / total) for i, w in weights.items()}
    for i, s in scores.items():
        logs[i] = s
    least = min(scores.values())
    for i in byte_ids:
        logs[i] = least - math.log(2)
    cuts = not any(re.search(f"[^{MARK}]{MARK}", p) or ("\n" in p and p != "\n") for p in ids)
    return Vocabulary(ids, logs, byte_ids, texts, max(map(len, ids)), cuts)
