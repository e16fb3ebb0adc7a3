"""The pieces of a public subword vocabulary, as bytes, with weights that follow from their order in its file."""

from __future__ import annotations

import functools

import numpy as np

#: Stands for the beginning of a word, in pieces and in front of words; words hold no blanks themselves.
START = b" "


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@functools.lru_cache(maxsize=2)
def load(path: str) -> tuple[list[bytes], np.ndarray]:
    """All pieces, among them every single byte, and their natural-log weights; the weights sum to one.

    The file's scores are ranks: the k-th piece scores -k. By Zipf's law a piece of rank k has a probability in
    proportion to 1 / (k + 10), the offset keeping the first few from taking all. Bytes, which stand in for
    characters without a piece, come last.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    score: dict[bytes, float] = {}
    for number in range(model.get_piece_size()):
        if model.is_byte(number) or model.is_control(number) or model.is_unknown(number) or model.is_unused(number):
            continue
        piece = model.id_to_piece(number).replace("▁", " ").encode()
        if START not in piece[1:]:
            score[piece] = max(score.get(piece, -np.inf), model.get_score(number))
    pieces = sorted(score, key=lambda piece: (-score[piece], piece))
    pieces += [bytes([byte]) for byte in range(256) if bytes([byte]) not in score]
    weights = 1.0 / (np.arange(len(pieces)) + 10.0)
    return pieces, np.log(weights / weights.sum())
