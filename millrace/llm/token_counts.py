"""Token counts of a unigram tokenizer by dynamic programming on a trie of pre-tokens."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from millrace.llm.words import words

#: Nodes of a worker's trie beyond which it starts anew, so that its memory stays bounded.
NODES = 400_000
#: What a pre-token begins with in the vocabulary's pieces.
SPACE = "▁"
#: Score of one byte of a character that no piece covers.
BYTE = -20.0


def unigram_scores(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece vocabulary file with log probabilities, read on the driver: some ten thousand entries.

    The file ranks its pieces; the probability of the piece of rank r is taken as 1 / (r + 2.7), normalised, as frequencies of
    pieces fall. A file that holds log probabilities of a unigram model is used as it is.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    given = {model.id_to_piece(i): model.get_score(i) for i in ids}
    ranked = all(score == int(score) for score in given.values())
    if not ranked:
        return given
    weights = {piece: 1 / (rank + 2.7) for rank, piece in enumerate(sorted(given, key=lambda p: -given[p]), 1)}
    total = math.log(sum(weights.values()))
    return {piece: math.log(weight) - total for piece, weight in weights.items()}


def cuts(pieces: Iterable[str]) -> re.Pattern:
    """How a text falls into pre-tokens that no piece runs over, so that their best splits make up that of the whole text.

    Spaces begin a pre-token if no piece has one after another character, and a line feed is one of its own if no piece holds it
    together with others. A vocabulary with other pieces has its texts split whole.
    """
    pieces = [p for p in pieces if len(p) > 1]
    if any("\n" in p or SPACE in p.lstrip(SPACE) for p in pieces):
        return re.compile(r"[\s\S]+")
    return re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


class Counts(dict):
    """Counts of words; that of a new one is asked for and kept."""

    def __init__(self, new: Callable[[bytes | str], int]):
        self.new = new

    def __missing__(self, word: bytes | str) -> int:
        found = self[word] = self.new(word)
        return found


class Trie:
    """Pre-tokens share the nodes of their prefixes; each node keeps the best score of its prefix and the tokens of that split.

    The best split of a prefix depends on the prefix alone, so it is computed when the node is made, once for all pre-tokens that
    begin with it. The last node of a pre-token thus stores its count. Of equal scores the split with fewer tokens counts.
    """

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        #: Lengths of the pieces of more than one character by their last two, the longest first: no other one can end there.
        lengths: dict[str, set[int]] = {}
        for piece in scores:
            if len(piece) > 1:
                lengths.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {tail: sorted(known, reverse=True) for tail, known in lengths.items()}
        self.terminal = Counts(self.new)
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.best: list[tuple[float, int]] = [(0.0, 0)]
        self.terminal.clear()

    def count(self, word: bytes | str) -> int:
        """Tokens of a word in UTF-8, before which a space is put, or of a pre-token as it stands."""
        return self.terminal[word]

    def total(self, words: Iterable[bytes | str]) -> int:
        """Tokens of all of them; those met before cost a lookup and no call."""
        return sum(map(self.terminal.__getitem__, words))

    def new(self, word: bytes | str) -> int:
        """The count of a word that has none yet."""
        if len(self.best) > NODES or len(self.terminal) > NODES:
            self.clear()
        return self._insert(word if isinstance(word, str) else SPACE + word.decode("utf-8", "surrogatepass"))

    def _insert(self, token: str) -> int:
        path, node = [0], 0
        for i, character in enumerate(token):
            after = self.children[node].get(character)
            if after is None:
                after = len(self.best)
                self.children[node][character] = after
                self.children.append({})
                self.best.append(self._forward(token, i + 1, path))
            path.append(node := after)
        return self.best[node][1]

    def _forward(self, token: str, end: int, path: list[int]) -> tuple[float, int]:
        score, tokens = self.best[path[end - 1]]
        single = self.scores.get(token[end - 1])
        if single is None:
            width = len(token[end - 1].encode("utf-8", "surrogatepass"))
            best = (score + BYTE * width, tokens + width)
        else:
            best = (score + single, tokens + 1)
        for length in self.lengths.get(token[end - 2 : end], ()) if end > 1 else ():
            if length > end:
                continue
            piece = self.scores.get(token[end - length : end])
            if piece is not None:
                score, tokens = self.best[path[end - length]]
                if score + piece > best[0] or (score + piece == best[0] and tokens + 1 < best[1]):
                    best = (score + piece, tokens + 1)
        return best


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", raw: bool = False) -> DataFrame:
    """doc_id, n_words and n_tokens of each row: lower-cased words between white space are the pre-tokens.

    With `raw`, n_tokens is that of the text as it is: case, each space and each line feed count, as in the vocabulary's own encoder,
    which puts one space before the text.

    The vocabulary goes to every task, as it has a fixed size. Tasks insert distinct pre-tokens in a trie of their own and add up the
    counts, so no row is moved. Null and empty texts have 0 of both. Ids may be null or repeat; other columns are not looked at.
    """
    scores = docs.sparkSession.sparkContext.broadcast(unigram_scores(path))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = Trie(scores.value)
        cut = cuts(scores.value)

        def tokens_of(text: str | None, found: list[bytes]) -> int:
            if not raw:
                return trie.total(found)
            return trie.total(cut.findall(SPACE + text.replace(" ", SPACE))) if text else 0

        for frame in frames:
            found = [words(text) for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "n_words": [len(x) for x in found],
                    "n_tokens": list(map(tokens_of, frame["text"], found)),
                }
            )

    plain = docs.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"`{text_column}` as text")
    return plain.mapInPandas(count, "doc_id long, n_words long, n_tokens long")
