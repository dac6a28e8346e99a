"""Reading a public SentencePiece vocabulary file on the driver."""

from __future__ import annotations

from typing import NamedTuple

SPACE = "▁"


class Vocabulary(NamedTuple):
    pieces: list[str]        # by id; "" for control, unknown and byte pieces
    scores: list[float]
    byte_ids: list[int]      # id of each of the 256 byte pieces, or -1


def load(path: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    byte_ids = [-1] * 256
    pieces, scores = [], []
    for i in range(n):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
        ordinary = not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        pieces.append(p if ordinary else "")
        scores.append(sp.get_score(i))
    return Vocabulary(pieces, scores, byte_ids)


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))
