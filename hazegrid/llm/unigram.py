"""Token counts under a unigram vocabulary, by a Viterbi search that carries counts only.

The counts are those of the `tokenizers` library's Unigram model behind its Metaspace splitter: a space starts a
new piece of text, no token spans two of them, and each gets the segmentation of highest score. An Aho-Corasick
automaton lists the vocabulary's matches by their last character. For each end the search keeps best score, token
count and whether the last token is unknown. Ties: the longest last token wins. A character without a token of its
own costs the lowest score of the vocabulary less 10, and neighbouring unknown characters are one token.

Null and empty text have no tokens.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame

from hazegrid.llm.columns import added

#: Fixed values of the model: the sign of a space, and what an unknown character costs besides the lowest score.
SPACE = "▁"
PENALTY = 10.0
#: Pieces of text whose counts a worker keeps; beyond, it starts anew. Memory only, no effect on results.
KEPT = 200_000


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, the unknown token first; control and byte tokens aren't text."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    unknown = model.unk_id()
    return [(model.id_to_piece(unknown), model.get_score(unknown))] + [
        (model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
        if i != unknown and not (model.is_control(i) or model.is_byte(i) or model.is_unused(i) or model.is_unknown(i))]


class Counter:
    def __init__(self, vocabulary: tuple[tuple[str, float], ...]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for k, (piece, score) in enumerate(vocabulary):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, k == 0))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - PENALTY
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.known: dict[str, int] = {}

    def search(self, piece: str) -> int:
        """Tokens of one piece of text: best[i], count[i], open[i] hold for its first i characters."""
        n = len(piece)
        best: list[float] = [0.0] + [float("-inf")] * n
        start = [0] * (n + 1)
        count = [0] * (n + 1)
        is_open = [False] * (n + 1)
        matches = self.automaton.iter(piece)
        following = next(matches, None)
        for end in range(1, n + 1):
            while following is not None and following[0] == end - 1:
                length, score, unknown = following[1]
                self._relax(best, start, count, is_open, end - length, end, score, unknown)
                following = next(matches, None)
            if piece[end - 1] not in self.single:
                self._relax(best, start, count, is_open, end - 1, end, self.unknown, True)
        return count[n]

    @staticmethod
    def _relax(best, start, count, is_open, begin, end, score, unknown) -> None:
        total = score + best[begin]
        if total > best[end] or total == best[end] and begin < start[end]:
            best[end], start[end], is_open[end] = total, begin, unknown
            count[end] = count[begin] + (not (unknown and is_open[begin]))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = text.replace(" ", SPACE).split(SPACE)
        if not pieces[0]:
            pieces = pieces[1:]
        known, total = self.known, 0
        for piece in pieces:
            n = known.get(piece)
            if n is None:
                n = self.search(SPACE + piece)
                if len(known) >= KEPT:
                    known.clear()
                if len(piece) < 64:
                    known[piece] = n
            total += n
        return total


@functools.lru_cache(2)
def _counter(vocabulary: tuple[tuple[str, float], ...]) -> Counter:
    return Counter(vocabulary)


def count_tokens(df: DataFrame, path: str, text: str = "text", count: str = "n_tokens") -> DataFrame:
    """`df` with the long column `count`: tokens of `text` under the vocabulary file, which is read once, on the driver.

    The vocabulary has a fixed size, about 1 MB for 32,000 pieces, and travels with the task.
    """
    vocabulary = tuple(read_vocabulary(path))

    def make(column: pa.Array) -> list:
        counter = _counter(vocabulary)
        return [pa.array([counter.count(t) for t in column.to_pylist()], pa.int64())]

    return added(df, f"`{count}` long", text, make)
