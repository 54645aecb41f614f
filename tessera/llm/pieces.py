"""The unigram view of a SentencePiece vocabulary file.

Only the pieces, their scores and their kinds are used: a text is cut into the
pieces with the largest sum of scores, whatever algorithm the file was made
for.  A character that no piece covers becomes its UTF-8 bytes where the file
has byte pieces, else the unknown piece.

Texts are put in the file's form first: a space in front, all spaces as
``MARK``.  They fall apart before each run of marks: no piece has a mark behind
another character (which is checked), so a text is the sequence of its
pre-tokens and each pre-token can be cut by itself.  Line ends and tabs, when
no piece holds them, are pre-tokens too.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

MARK = "▁"
#: What an uncovered character costs beside the lowest score of the file.
UNKNOWN_PENALTY = 10.0


@dataclass
class PieceVocabulary:
    pieces: list[str]
    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    unknown_id: int
    unknown_score: float
    max_chars: int
    control: list[bool]
    units: re.Pattern = field(repr=False)

    @classmethod
    def load(cls, path: str) -> PieceVocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        control = [bool(m.is_control(i) or m.is_unknown(i) or m.is_unused(i)) for i in range(len(pieces))]
        is_byte = [bool(m.is_byte(i)) for i in range(len(pieces))]
        normal = {p: (m.get_score(i), i) for i, p in enumerate(pieces) if not (control[i] or is_byte[i])}
        lowest = min(s for s, _ in normal.values())
        if crossing := [p for p in normal if MARK in p.lstrip(MARK)]:
            raise ValueError(f"the piece {crossing[0]!r} crosses words")
        found = {int(pieces[i][3:5], 16): i for i in range(len(pieces)) if is_byte[i]}
        breaks = "".join(c for c in "\n\r\t" if not any(c in p for p in normal))
        units = re.compile(f"{MARK}*[^{MARK}{breaks}]+|{MARK}+" + (f"|[{breaks}]" if breaks else ""))
        return cls(pieces, {p: s for p, (s, _) in normal.items()}, {p: i for p, (_, i) in normal.items()},
                   [found[b] for b in range(256)] if len(found) == 256 else [], m.unk_id(),
                   lowest - UNKNOWN_PENALTY, max(map(len, normal)), control, units)

    def pre_tokens(self, text: str) -> list[str]:
        return self.units.findall(MARK + text.replace(" ", MARK)) if text else []

    def uncovered(self, char: str) -> list[int]:
        """Ids for a character without a piece."""
        if not self.byte_ids:
            return [self.unknown_id]
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]

    def piece_bytes(self) -> list[bytes]:
        """What each id stands for in a decoded text."""
        out = [b"" if c else p.replace(MARK, " ").encode() for p, c in zip(self.pieces, self.control)]
        for b, i in enumerate(self.byte_ids):
            out[i] = bytes([b])
        if not self.byte_ids:
            out[self.unknown_id] = "⁇".encode()
        return out


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
