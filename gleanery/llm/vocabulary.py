"""A SentencePiece vocabulary read as a unigram model, and how texts fall into words.

The file's pieces and scores are used as they are; nothing is trained. A text gets a leading
space, and spaces become U+2581. No piece has U+2581 behind another character, so the best
segmentation of a text is that of its words, a word being U+2581s and what follows them up to the
next U+2581.

Tie rules of the tokenizer: of equally good ways to reach a position the one whose last
piece starts earliest wins. A character without a piece of its own may stand as unknown, at
10 below the lowest score, and is written as its UTF-8 bytes. Scores are added as 64-bit floats.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

SPACE = "▁"
#: Default place of the vocabulary; every operator takes another path.
PATH = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_BELOW = 10.0
WORD = re.compile(f"{SPACE}+[^{SPACE}]*")


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]  # by id; control pieces are empty
    scores: tuple[float, ...]
    matched: tuple[int, ...]  # ids of pieces that texts are matched with
    bytes_from: tuple[int, ...]  # id of every byte
    unknown_score: float

    def plain(self) -> tuple:
        """For a broadcast, which carries built-in types only: Vocabulary(*plain) gives it back."""
        return self.pieces, self.scores, self.matched, self.bytes_from, self.unknown_score


def load(path: str = PATH) -> Vocabulary:
    """Read a vocabulary file on the driver; it is of fixed size whatever the corpus."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = [""] * size
    for i in plain:
        pieces[i] = model.id_to_piece(i)
        if SPACE in pieces[i].lstrip(SPACE):
            raise ValueError(f"piece {i} goes over the start of a word")
    scores = tuple(model.get_score(i) for i in range(size))
    in_bytes = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    if len(set(in_bytes)) != 256:
        raise ValueError("the vocabulary has no pieces for bytes")
    return Vocabulary(tuple(pieces), scores, tuple(plain), in_bytes, min(scores[i] for i in plain) - UNKNOWN_BELOW)


def words(text: str | None) -> list[str]:
    """The words of a text; none for a null or empty one."""
    return WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []
