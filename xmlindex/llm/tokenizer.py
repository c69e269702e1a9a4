"""Public tokenizer files as encoders that work on pieces of bounded size.

`encoder(path)` gives the ids that the file's own library gives for whole texts, without begin,
end or added special tokens; special strings inside a text become their ids, as the library does
by default. Byte-level BPE files are run by the rank-based merger, which makes the same merges in
the same order and is about four times as fast; that the file is of this kind is checked when it
is read, every other file is left to its library.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import partial

import numpy as np
import regex

from xmlindex.llm.support import held

# The pattern that splits text before the merges, and white space as it sees it.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Places where that pattern always ends a word, whatever lies further away. After an
# apostrophe it may take letters along, and white space is split by what follows it.
WORD_END = r"""(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=[^\p{White_Space}\p{L}\p{N}])(?=\p{White_Space})|(?<=[^\p{White_Space}\p{L}\p{N}'])(?=[\p{L}\p{N}])"""
# Text of one kind, long enough that no contraction reaches across it. White space
# is none, as its last character may belong to what follows.
ONE_KIND = r"""\p{L}{3,}|\p{N}{3,}|[^\p{White_Space}\p{L}\p{N}']{3,}"""

# Characters encoded in one go.
LEAF_CHARS = 16_384


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def file_version(path: str) -> str:
    """A digest of the tokenizer file: counts and ids hold for this version only."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


class ByteLevelEncoder:
    """Byte-level BPE whose merge order is the order of its ids."""

    kind = "byte_bpe"

    def __init__(self, ranks: dict[bytes, int], specials: dict[str, int]):
        import tiktoken

        self.specials = specials
        self.core = tiktoken.Encoding(
            "file", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens=specials
        )
        self.size = max([*ranks.values(), *specials.values()]) + 1
        self._word_end = regex.compile(WORD_END)
        self._one_kind = regex.compile(ONE_KIND)
        self._special = (
            regex.compile("|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)))
            if specials else None
        )

    def leaves(self, text: str, leaf_chars: int = LEAF_CHARS) -> Iterator[tuple[str, str]]:
        """The text as (kind, piece) of bounded length, in order.

        `text`: a stretch between special strings that is short enough. `special`: a special
        string. `open` and `part`: consecutive pieces of a longer stretch, halved wherever its
        middle falls until the pieces are short enough; `open` begins such a stretch.
        """
        if len(text) <= leaf_chars:
            if text:
                yield "text", text
            return
        start = 0
        for match in self._special.finditer(text) if self._special else ():
            yield from self._section(text, start, match.start(), leaf_chars)
            yield "special", match.group()
            start = match.end()
        yield from self._section(text, start, len(text), leaf_chars)

    def _section(self, text: str, start: int, end: int, leaf_chars: int) -> Iterator[tuple[str, str]]:
        if end - start <= leaf_chars:
            if end > start:
                yield "text", text[start:end]
            return
        pieces = 1
        while -(-(end - start) // pieces) > leaf_chars:
            pieces *= 2
        cuts = [start + (end - start) * i // pieces for i in range(pieces + 1)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield "part" if i else "open", text[a:b]

    def encode_leaf(self, kind: str, piece: str) -> np.ndarray:
        if kind == "text":
            return self.core.encode_to_numpy(piece, allowed_special="all")
        if kind == "special":
            return np.array([self.specials[piece]], np.uint32)
        return np.array(self.core.encode_ordinary(piece), np.uint32)

    def join(self, left: np.ndarray, right: np.ndarray, window: int = 8) -> np.ndarray:
        """The ids of a stretch from those of its two halves.

        A window of ids around the join is encoded again, and grows until it agrees with both
        sides. A side agrees from a place on where a word ends for certain, because there what
        lies beyond is split and merged by itself. Where a side is all letters, or of another
        single kind, it has no such place, and agrees if the outermost id is the one that it has
        there: a row of ids is a word's encoding if each two neighbours are that of their bytes.
        """
        while True:
            found = self._window(left, right, window)
            if found is not None:
                return found
            window *= 2

    def _window(self, left: np.ndarray, right: np.ndarray, window: int) -> np.ndarray | None:
        a, b = left[-window:], right[:window]
        all_left, all_right = len(a) == len(left), len(b) == len(right)
        before, after = self.core.decode_bytes(a.tolist()), self.core.decode_bytes(b.tolist())
        try:
            text, other = before.decode(), after.decode()
        except UnicodeDecodeError:  # an end of the window is inside of a character
            return None
        middle = np.array(self.core.encode_ordinary(text + other), np.uint32)
        ends = [m.start() for m in self._word_end.finditer(text + other)]
        first = next((e for e in ends if 0 < e < len(text)), None)
        last = next((e for e in reversed(ends) if len(text) < e < len(text) + len(other)), None)
        # Ids that stand on each side, and those of the window between them.
        start, stop, keep_left, keep_right = 0, len(middle), len(left) - len(a), len(b)
        if not all_left:
            if first is not None:
                size = len(text[:first].encode())
                start, keep = self._ids_of(middle, size), self._ids_of(a, size)
                if start is None or keep is None:
                    return None
                keep_left += keep
            elif not (self._one_kind.fullmatch(text) and len(middle) > 1 and middle[0] == a[0]):
                return None
        if not all_right:
            if last is not None:
                size = len(before) + len(other[: last - len(text)].encode())
                stop, keep_right = self._ids_of(middle, size), self._ids_of(b, size - len(before))
                if stop is None or keep_right is None:
                    return None
            elif not (self._one_kind.fullmatch(other) and len(middle) > 1 and middle[-1] == b[-1]):
                return None
        return np.concatenate([left[:keep_left], middle[start:stop], right[keep_right:]])

    def _ids_of(self, ids: np.ndarray, size: int) -> int | None:
        """How many of the first ids make `size` bytes; none if an id reaches across."""
        for n, one in enumerate(ids.tolist()):
            if size <= 0:
                break
            size -= len(self.core.decode_single_token_bytes(one))
        else:
            n = len(ids)
        return n if size == 0 else None

    def join_tree(self, halves: list[np.ndarray]) -> np.ndarray:
        while len(halves) > 1:
            joined = [self.join(a, b) for a, b in zip(halves[::2], halves[1::2])]
            halves = joined + halves[len(joined) * 2:]
        return halves[0]

    def assemble(self, leaves: list[tuple[str, np.ndarray]]) -> np.ndarray:
        """The ids of a text from those of its leaves."""
        done: list[np.ndarray] = []
        word: list[np.ndarray] = []
        for kind, ids in leaves:
            if kind != "part" and word:
                done.append(self.join_tree(word))
                word = []
            if kind in ("open", "part"):
                word.append(ids)
            else:
                done.append(ids)
        if word:
            done.append(self.join_tree(word))
        return np.concatenate(done) if done else np.zeros(0, np.uint32)

    def encode(self, text: str, leaf_chars: int = LEAF_CHARS) -> np.ndarray:
        if len(text) <= leaf_chars:
            return self.core.encode_to_numpy(text, allowed_special="all")
        return self.assemble([(kind, self.encode_leaf(kind, x)) for kind, x in self.leaves(text, leaf_chars)])

    def decode(self, ids: np.ndarray) -> str:
        return self.core.decode_bytes(ids.tolist()).decode("utf-8", errors="replace")


class LibraryEncoder:
    """Any other file, by its own library, whole texts at a time."""

    kind = "library"

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size = model.get_piece_size()
            self._encode = partial(model.encode, num_threads=1)
            self._decode = model.decode
        else:
            from tokenizers import Tokenizer

            tokens = Tokenizer.from_file(path)
            tokens.no_truncation()
            tokens.no_padding()
            self.size = tokens.get_vocab_size(with_added_tokens=True)
            self._encode = lambda text: tokens.encode(text, add_special_tokens=False).ids
            self._decode = lambda ids: tokens.decode(ids, skip_special_tokens=False)

    def leaves(self, text: str, leaf_chars: int = LEAF_CHARS) -> Iterator[tuple[str, str]]:
        if text:
            yield "text", text

    def encode_leaf(self, kind: str, piece: str) -> np.ndarray:
        return self.encode(piece)

    def assemble(self, leaves: list[tuple[str, np.ndarray]]) -> np.ndarray:
        return leaves[0][1] if leaves else np.zeros(0, np.uint32)

    def encode(self, text: str, leaf_chars: int = LEAF_CHARS) -> np.ndarray:
        return np.array(self._encode(text), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return self._decode(ids.tolist())


def _load(path: str) -> ByteLevelEncoder | LibraryEncoder:
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        model, splitter = found["model"], found.get("pre_tokenizer") or {}
        added = found.get("added_tokens", [])
        byte_level = (
            model["type"] == "BPE" and not found.get("normalizer") and not model.get("dropout")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and not model.get("ignore_merges") and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
            and all(a["special"] and not (a["lstrip"] or a["rstrip"] or a["single_word"]) for a in added)
        )
        if byte_level:
            alphabet = byte_alphabet()
            specials = {a["content"]: a["id"] for a in added}
            vocabulary = {t: i for t, i in model["vocab"].items() if t not in specials}
            merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
            order = [vocabulary[m] for m in merged]
            if order == sorted(set(order)) and len(vocabulary) == 256 + len(order):
                ranks = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.items()}
                return ByteLevelEncoder(ranks, specials)
    return LibraryEncoder(path)


def encoder(path: str) -> ByteLevelEncoder | LibraryEncoder:
    """The encoder of a tokenizer file, loaded once per Python worker."""
    return held(("encoder", path), partial(_load, path))
