"""Tokenising texts by their different space-separated chunks.

Both public byte-level vocabularies part text by one pattern before they merge. Between two
characters that aren't white space, a single space starts a new piece and a single line feed is one
by itself, whatever stands around. So a text can be cut at such places and each different chunk
tokenised once; texts with other white space are tokenised whole.
"""

from __future__ import annotations

from collections.abc import Callable

#: Chunks remembered by a task. More are tokenised again; results don't depend on it.
REMEMBERED = 700_000
#: Letters before this one are letters to every version of Unicode in use.
LATIN_END = "\u0250"


class Chunks:
    """Token ids of texts as bytes, remembered by chunk.

    ``encode`` maps texts to their ids as bytes; ``newline`` is what it gives for a line feed.
    ``encode_parts``, where given, does so for texts that may be encoded as one, end to end.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        encode_parts: Callable[[list[str]], list[bytes]] | None = None,
        remembered: int = REMEMBERED,
    ):
        self.encode, self.encode_parts = encode, encode_parts or encode
        self.newline = encode(["\n"])[0]
        self.ends = {c: encode([c])[0] for c in ",."}
        self.remembered = remembered
        self.first: dict[str, bytes | None] = {}  # at the start of a line
        self.later: dict[str, bytes | None] = {}  # after a space

    def _learn(self, known: dict[str, bytes | None], new: set[str], before: str) -> None:
        good = {c for c in new if c and not c[0].isspace() and not c[-1].isspace()}
        known.update(dict.fromkeys(new))
        # A comma or full stop after a letter is a piece by itself.
        ended = {c for c in good if len(c) > 1 and c[-1] in self.ends and c[-2].isalpha() and c[-2] < LATIN_END}
        alone = [*(good - ended), *{c[:-1] for c in ended}.difference(known)]
        cut = len(self.newline) if before == "\n" else 0
        known.update(zip(alone, (x[cut:] for x in self.encode_parts([before + c for c in alone]))))
        known.update((c, known[c[:-1]] + self.ends[c[-1]]) for c in ended)

    def _joined(self, lines: list[list[str]]) -> bytes | None:
        """Ids of a text cut into lines and chunks; None if it has other white space."""
        first, later = self.first, self.later
        try:
            return self.newline.join([b"".join([first[x[0]], *map(later.__getitem__, x[1:])]) for x in lines])
        except TypeError:  # a chunk that stands without ids
            return None

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self.first) + len(self.later) > self.remembered:
            self.first, self.later = {}, {}
        out: list[bytes | None] = []
        waiting = {}
        for i, text in enumerate(texts):
            lines = [line.split(" ") for line in text.split("\n")]
            try:
                out.append(self._joined(lines))
            except KeyError:
                out.append(None)
                waiting[i] = lines
        self._learn(self.first, {x[0] for lines in waiting.values() for x in lines if x[0] not in self.first}, "\n")
        self._learn(self.later, {c for lines in waiting.values() for x in lines for c in x[1:] if c not in self.later}, " ")
        for i, lines in waiting.items():
            out[i] = self._joined(lines)
        whole = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(whole, self.encode([texts[i] for i in whole])):
            out[i] = x
        return out
