"""Splitting of texts into the pieces that byte-level BPE merges, without regular expressions.

Every codepoint becomes a symbol: letter, number, white space or other, refined by what
the next codepoints are. A finite automaton reads the symbols; each symbol is a function
from states to states, and as composing functions is associative, the state before every
codepoint comes from a scan over blocks: all blocks compose their functions side by side,
the blocks' functions are composed by doubling, and all blocks replay from their true
states. Functions of four symbols are tabled, so a step reads four codepoints.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# The endings that an apostrophe takes with it (fixed values).
ONE_LETTER_ENDINGS = ("s", "t", "m", "d")
TWO_LETTER_ENDINGS = ("re", "ve", "ll")

OTHER, LETTER, NUMBER, SPACE = range(4)
# Symbols: the classes, white space by what follows it, apostrophes by the ending that
# follows, and the gap between two texts.
(
    SYM_OTHER, SYM_LETTER, SYM_NUMBER, SYM_SPACE_INNER, SYM_SPACE_JOINS, SYM_SPACE_LAST,
    SYM_ENDING_1, SYM_ENDING_2, SYM_GAP,
) = range(9)
# States: what the last codepoint was part of.
(
    IN_NOTHING, IN_OTHER, IN_LETTERS, IN_NUMBERS, IN_SPACE, AFTER_JOINING_SPACE,
    ONE_MORE, TWO_MORE,
) = range(8)
STATES, SYMBOLS, BLOCK = 8, 9, 64


@cache
def _classes() -> np.ndarray:
    """The class of every codepoint by the Unicode tables of tiktoken's own splitter, which may
    be newer than Python's. It is asked once in each Python worker, for single codepoints."""
    import tiktoken

    every = "".join(chr(code) for code in range(0x110000) if not 0xD800 <= code < 0xE000)
    single_bytes = {bytes([x]): x for x in range(256)}
    found = np.zeros(0x110000, np.uint8)
    for own, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        # What a pattern does not match gives no ids, so the ids are the bytes of the class.
        matches = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single_bytes, special_tokens={})
        members = bytes(matches.encode_ordinary(every)).decode()
        found[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = own
    return found


@cache
def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a piece starts here", by symbol and state."""
    step = np.zeros((SYMBOLS, STATES), np.uint8)
    starts = np.ones((SYMBOLS, STATES), bool)
    for state in range(STATES):
        ending = state in (ONE_MORE, TWO_MORE)
        for symbol, own in ((SYM_OTHER, IN_OTHER), (SYM_LETTER, IN_LETTERS), (SYM_NUMBER, IN_NUMBERS)):
            step[symbol, state] = own
            starts[symbol, state] = state not in (own, AFTER_JOINING_SPACE)
        if ending:
            # The ending's letters; only letters follow such an apostrophe.
            step[SYM_LETTER, state] = ONE_MORE if state == TWO_MORE else IN_NOTHING
            starts[SYM_LETTER, state] = False
        for symbol, after in ((SYM_ENDING_1, ONE_MORE), (SYM_ENDING_2, TWO_MORE)):
            joined = state in (IN_OTHER, AFTER_JOINING_SPACE)
            step[symbol, state] = IN_OTHER if joined else after
            starts[symbol, state] = not joined
        # All but the last of a run of white space is one piece; the last one is the start
        # of the next piece if it is a blank, else a piece of its own.
        step[SYM_SPACE_INNER, state] = IN_SPACE
        starts[SYM_SPACE_INNER, state] = state != IN_SPACE
        step[SYM_SPACE_JOINS, state] = AFTER_JOINING_SPACE
        step[SYM_SPACE_LAST, state] = IN_NOTHING
        step[SYM_GAP, state] = IN_NOTHING
    return step, starts


def _symbols(codes: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    kind = _classes()[codes]
    symbols = kind.copy()
    after = np.empty_like(kind)
    after[:-1], after[-1] = kind[1:], OTHER
    space = kind == SPACE
    ends_text = np.zeros(len(codes), bool)
    ends_text[gaps - 1] = True
    # White space before white space, or at the end of its text, goes with its run.
    inner = space & ((after == SPACE) | ends_text)
    symbols[inner] = SYM_SPACE_INNER
    last = space & ~inner
    symbols[last] = np.where(codes[last] == 0x20, SYM_SPACE_JOINS, SYM_SPACE_LAST)
    marks = np.flatnonzero(codes == ord("'"))
    if len(marks):
        padded = np.concatenate((codes, np.zeros(2, codes.dtype)))
        one, two = padded[marks + 1], padded[marks + 2]
        short = np.isin(one, [ord(x) for x in ONE_LETTER_ENDINGS])
        long = np.zeros(len(marks), bool)
        for first, second in TWO_LETTER_ENDINGS:
            long |= (one == ord(first)) & (two == ord(second))
        symbols[marks[short]] = SYM_ENDING_1
        symbols[marks[long]] = SYM_ENDING_2
    symbols[gaps] = SYM_GAP
    return symbols


@cache
def _steps_of_four() -> tuple[np.ndarray, np.ndarray]:
    """The automaton over words of four symbols: the composed function of each word, and
    the four starts it gives from each state, one byte each."""
    step, starts = _automaton()
    words = np.indices((SYMBOLS,) * 4).reshape(4, -1)
    state = np.tile(np.arange(STATES), (words.shape[1], 1))
    flags = np.zeros((*state.shape, 4), np.uint8)
    for i in range(4):
        flags[..., i] = starts[words[i][:, None], state]
        state = step[words[i][:, None], state]
    return state.astype(np.uint8).reshape(-1), flags.view(np.uint32).reshape(-1)


def _starts(symbols: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each symbol, by a scan over composed functions."""
    step, flags = _steps_of_four()
    width = 4 * BLOCK
    padded = np.full(-(-len(symbols) // width) * width, SYM_GAP, np.uint8)
    padded[: len(symbols)] = symbols
    fours = padded.reshape(-1, 4)
    words = fours[:, 0].astype(np.int32)
    for i in range(1, 4):
        words *= SYMBOLS
        words += fours[:, i]
    rows = np.ascontiguousarray(words.reshape(-1, BLOCK).T) * STATES
    blocks = rows.shape[1]
    # What each block makes of each state.
    whole = np.tile(np.arange(STATES, dtype=np.uint8)[:, None], (1, blocks))
    for row in rows:
        whole = step.take(row + whole)
    # What all blocks up to each block make of it, by doubling the reach.
    reach = 1
    while reach < blocks:
        later = whole.copy()
        later[:, reach:] = np.take_along_axis(whole[:, reach:], whole[:, :-reach].astype(np.intp), axis=0)
        whole = later
        reach *= 2
    state = np.full(blocks, IN_NOTHING, np.uint8)
    state[1:] = whole[IN_NOTHING, :-1]
    found = np.empty(rows.shape, np.uint32)
    for i, row in enumerate(rows):
        at = row + state
        found[i] = flags.take(at)
        state = step.take(at)
    return np.ascontiguousarray(found.T).view(np.uint8).reshape(-1)[: len(symbols)].astype(bool)


def boundaries(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts joined by one gap codepoint each, the starts of their pieces in it, and
    for every text the number of pieces before it (with a last entry for the total).

    The gaps themselves start no piece; an empty text has none.
    """
    joined = "\0".join(texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    gaps = np.cumsum(sizes + 1) - 1
    symbols = _symbols(codes, gaps)
    begins = _starts(symbols)
    begins[gaps] = False
    at = np.flatnonzero(begins)
    return joined, at, np.concatenate(([0], np.searchsorted(at, gaps)))


def pieces(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The pieces of all texts in order, their starts within their own text, and the number
    of pieces before every text."""
    if not texts:
        return [], np.empty(0, np.int64), np.zeros(1, np.int64)
    joined, at, first = boundaries(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.cumsum(sizes + 1) - sizes - 1
    counts = np.diff(first)
    # A piece ends where the next one of its text starts, the last one where the text ends.
    ends = np.append(at[1:], len(joined))[: len(at)]
    ends[first[1:][counts > 0] - 1] = (base + sizes)[counts > 0]
    cut = [joined[a:b] for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
    return cut, at - np.repeat(base, counts), first
