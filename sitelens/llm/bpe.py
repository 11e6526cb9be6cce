"""BPE encoding and decoding.

``encode_documents`` adds exact token ids to a table of texts and
``decode_documents`` turns ids back into text; both run per Arrow batch inside
``mapInArrow`` (no shuffle, rows are independent).

Method: an Aho-Corasick automaton of the tokens, read from their ends, walks each
word once from its end and so yields the longest token that begins at every
position; its failure links also name the next shorter one.  A word is then
encoded left to right: the longest match is kept if it is *compatible* with
the token before it, otherwise the next shorter token of the same position is
tried, and when none is left the previous token is withdrawn and shortened.  A
position that was withdrawn once is never entered again, so the work is linear
in the word.  Two tokens are compatible when undoing their merges, latest
first, never meets a merge across their border that would have come earlier;
the answers are kept in a pair table.  Every prefix of a chain of compatible
tokens is the BPE of its text, so the result equals applying the merges in
order.  All words of a batch advance together as numpy arrays.

Decoding gathers each token's bytes from one blob by an offset table.

Defined results: a null or empty text has no tokens and decodes to the empty
text; other columns pass through unchanged; the strings of special tokens in a
text become the special ids (as the tokenizers library does by default).
Memory per task is bounded by ``CHUNK_BYTES`` of text at a time: longer texts
are cut where every supported pattern starts a new word, whatever is around it:
at white space between letters, after digits and marks (``_safe_cut``).  Only a
single word longer than that is held whole.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK_BYTES = 1 << 20
LONG_WORD = 256  # symbols; longer words are encoded one at a time
PAIR_SLOTS = 1 << 20

# Split patterns of the two tokenizer kinds.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SPACE, OTHER_SPACE, LETTER, NUMBER, OTHER, ODD = 0, 1, 2, 3, 4, 5


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    own = {b: chr(b) for b in plain}
    return [own.get(b) or chr(next(rest)) for b in range(256)]


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every (start, len) segment, concatenated."""
    lens = lens.astype(np.int64)
    ends = np.cumsum(lens)
    if not ends.size or not ends[-1]:
        return np.empty(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lens), lens)


def _latin_classes() -> np.ndarray:
    """Class of each code point below 256 under the split patterns."""
    import regex
    out = np.empty(256, np.uint8)
    for cp in range(256):
        ch = chr(cp)
        if regex.match(r"\p{L}", ch):
            out[cp] = LETTER
        elif regex.match(r"\p{N}", ch):
            out[cp] = NUMBER
        elif ch == " ":
            out[cp] = SPACE
        elif ch in "\t\n\r ":
            out[cp] = OTHER_SPACE
        else:
            out[cp] = ODD if cp < 32 or 127 <= cp < 160 else OTHER
    return out


class Bpe:
    """Tables of one vocabulary file and the encoder over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path = path
        self.suffix = model.get("end_of_word_suffix") or ""
        self.words = bool(self.suffix)  # word kind: lower case, white space dropped
        byte_of = {ch: b for b, ch in enumerate(byte_alphabet())}
        self.byte_of = byte_of
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [a + b for a, b in merges]
        made_set = set(made)
        if len(made_set) != len(made):
            raise ValueError("two merges make the same token; ranks would be ambiguous")
        base = sorted((t for t in vocab if t not in made_set and self._symbols(t) is not None
                       and len(self._symbols(t)) == 1), key=vocab.get)
        names = base + made  # own ids: single symbols, then merges in rank order
        own = {t: i for i, t in enumerate(names)}
        n = len(names)
        self.ext = np.array([vocab[t] for t in names], np.uint32)
        self.left, self.right = np.arange(n), np.arange(n)
        self.left[len(base):] = [own[a] for a, _ in merges]
        self.right[len(base):] = [own[b] for _, b in merges]
        keys = self.left[len(base):] * n + self.right[len(base):]
        order = np.argsort(keys)
        self.pair_keys, self.pair_made = keys[order], np.arange(len(base), n)[order]
        self.n = n
        self._build_automaton(names)
        self.seen = np.full(PAIR_SLOTS, -1, np.int64)
        self.fits = np.zeros(PAIR_SLOTS, bool)
        self.classes = _latin_classes()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.joined = spec.get("decoder") is None  # no decoder: token names, joined by spaces
        self._build_offsets(vocab)
        self._lib = None

    def _symbols(self, token: str) -> list[int] | None:
        body, last = token, 0
        if self.suffix and token.endswith(self.suffix):
            body, last = token[: -len(self.suffix)], 256
        syms = [self.byte_of.get(c, -1) for c in body]
        if not syms or -1 in syms:
            return None
        syms[-1] += last
        return syms

    def _build_automaton(self, names: list[str]) -> None:
        """Aho-Corasick automaton of the tokens read from their ends.

        Walked over a word from its last symbol to its first, its state after a
        symbol is the longest token part that begins there, and ``token_at`` of
        the state the longest token that begins there.
        """
        symbols = [self._symbols(name)[::-1] for name in names]
        self.length = np.array([len(x) for x in symbols], np.int64)
        wide = 512 if self.suffix else 256
        goto: dict[int, int] = {}
        node_of = np.zeros(self.n, np.int64)
        for t, syms in enumerate(symbols):
            node = 0
            for s in syms:
                node = goto.setdefault(node * 512 + s, len(goto) + 1)
            node_of[t] = node
        # states with children come first, so that only they have a row of moves
        inner = sorted({k // 512 for k in goto} | {0})
        number = np.zeros(len(goto) + 1, np.int64)
        number[inner] = np.arange(len(inner))
        leaves = np.setdiff1d(np.arange(len(goto) + 1), inner)
        number[leaves] = len(inner) + np.arange(len(leaves))
        self.inner = len(inner)
        keys = np.fromiter(goto.keys(), np.int64, len(goto))
        to = number[np.fromiter(goto.values(), np.int64, len(goto))]
        parent, sym = number[keys // 512], keys % 512
        self.goto = np.full((self.inner, wide), -1, np.int32)
        self.goto[parent, sym] = to
        self.token_at = np.full(len(number), -1, np.int64)
        self.token_at[number[node_of]] = np.arange(self.n)
        # failure links, level by level: the longest other token part that begins at the same place
        self.fail = np.zeros(len(number), np.int32)
        own = self.token_at.copy()
        level = np.flatnonzero(parent == 0)
        by_parent = np.argsort(parent, kind="stable")
        starts = np.searchsorted(parent[by_parent], np.arange(self.inner + 1))
        self.shorter = np.full(self.n, -1, np.int64)
        while level.size:
            at = level[parent[level] > 0]
            self.fail[to[at]] = self._move(self.fail[parent[at]], sym[at])
            nodes = to[level]
            behind = self.token_at[self.fail[nodes]]
            mine = own[nodes]
            self.shorter[mine[mine >= 0]] = behind[mine >= 0]       # the next shorter token of the same place
            self.token_at[nodes] = np.where(mine >= 0, mine, behind)
            grown = nodes[nodes < self.inner]
            level = by_parent[ragged(starts[grown], starts[grown + 1] - starts[grown])]

    def _move(self, state: np.ndarray, sym: np.ndarray) -> np.ndarray:
        """States after one symbol each: along a move, or along failure links to a state that has it, or the root."""
        out = np.zeros(len(state), np.int32)
        act = np.arange(len(state))
        while act.size:
            has = state < self.inner
            to = np.full(len(act), -1, np.int32)
            to[has] = self.goto[state[has], sym[has]]
            found = to >= 0
            out[act[found]] = to[found]
            on = ~found & (state > 0)       # the root itself has no other place to try
            act, state, sym = act[on], self.fail[state[on]], sym[on]
        return out

    def _build_offsets(self, vocab: dict[str, int]) -> None:
        """The offset table: bytes of id i are blob[off[i]:off[i+1]]."""
        by_id = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        parts = []
        for i in range(max(by_id) + 1):
            name = by_id.get(i, "")
            if self.joined or name in self.special:
                parts.append(name.encode())
            else:
                parts.append(bytes(self.byte_of[c] for c in name))
            if self.joined:
                parts[-1] += b" "
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.off = np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    # ---- encoding of words given as symbols

    def _longest(self, syms: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Longest token at every symbol of the words, one word after the other (one walk from each word's end)."""
        room = np.cumsum(size) - size
        best = np.full(int(size.sum()), -1, np.int64)
        order = np.argsort(-size, kind="stable")        # longer words are walked on when shorter ones have ended
        state = np.zeros(len(order), np.int32)
        far = size[order]
        for i in range(1, int(far[0]) + 1 if len(far) else 1):
            live = int(np.searchsorted(-far, -i, "right"))
            w = order[:live]
            state[:live] = self._move(state[:live], syms[start[w] + size[w] - i])
            best[room[w] + size[w] - i] = self.token_at[state[:live]]
        return best

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether b may follow a, from the pair table (filled on demand)."""
        key = a * self.n + b
        slot = (key * 0x9E3779B1 >> 7) & (PAIR_SLOTS - 1)
        out = self.fits[slot]
        miss = np.flatnonzero(self.seen[slot] != key)
        if miss.size:
            new, inv = np.unique(key[miss], return_inverse=True)
            val = self._undo(new // self.n, new % self.n)
            out[miss] = val[inv]
            s = (new * 0x9E3779B1 >> 7) & (PAIR_SLOTS - 1)
            # one slot may be asked for twice: key and answer are written by the same index
            last = np.unique(s[::-1], return_index=True)[1]
            pick = len(s) - 1 - last
            self.seen[s[pick]], self.fits[s[pick]] = new[pick], val[pick]
        return out

    def _undo(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo merges of a and b, latest first; false if a pair across the border would merge earlier."""
        fits = np.ones(len(a), bool)
        act = np.arange(len(a))
        limit = np.full(len(a), np.iinfo(np.int64).max)
        a, b = a.copy(), b.copy()
        while act.size:
            key = a * self.n + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            clash = (self.pair_keys[at] == key) & (self.pair_made[at] < limit)
            fits[act[clash]] = False
            left_later = a > b
            # the later of the two is undone; if it is a single symbol, the other one
            split_a = np.where(left_later, self.right[a] != a, self.left[b] == b)
            can_a, can_b = self.right[a] != a, self.left[b] != b
            go_a, go_b = split_a & can_a, ~split_a & can_b
            limit = np.where(go_a, a, np.where(go_b, b + 1, limit))
            na, nb = np.where(go_a, self.right[a], a), np.where(go_b, self.left[b], b)
            on = ~clash & (go_a | go_b)
            act, a, b, limit = act[on], na[on], nb[on], limit[on]
        return fits

    def encode_words(self, syms: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own token ids of words (segments of syms), concatenated, and their count per word."""
        n = len(start)
        room = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int32)
        border = room + np.arange(n)  # size+1 borders a word
        free = np.ones(len(out) + n, bool)
        longest = self._longest(syms, start, size)
        pos, count, last = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1, np.int64)
        act = np.flatnonzero(size > 0)
        tok = np.full(n, -1, np.int64)
        tok[act] = longest[room[act]]
        while act.size:
            t = tok[act]
            e = pos[act] + self.length[t]
            ok = free[border[act] + e]
            prev = last[act]
            ask = np.flatnonzero(ok & (prev >= 0))
            if ask.size:
                ok[ask] = self._compatible(prev[ask], t[ask])
            w, tw = act[ok], t[ok]
            out[room[w] + count[w]] = tw
            count[w] += 1
            pos[w], last[w] = e[ok], tw
            on = w[pos[w] < size[w]]
            if on.size:
                tok[on] = longest[room[on] + pos[on]]
            w = act[~ok]
            if w.size:
                less = self.shorter[t[~ok]]
                tok[w] = less
                back = w[less < 0]
                if back.size:
                    free[border[back] + pos[back]] = False
                    gone = last[back]
                    tok[back] = gone
                    count[back] -= 1
                    pos[back] -= self.length[gone]
                    last[back] = np.where(count[back] > 0, out[np.maximum(room[back] + count[back] - 1, 0)], -1)
                act = np.concatenate([on, w])
            else:
                act = on
        return out[ragged(room, count)], count

    # ---- split of texts into words

    def split_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of texts within ASCII and Latin-1: their start, bytes and class.

        data: bytes, followed by at least 16 zeros; offsets: borders of the texts.
        """
        n = int(offsets[-1])
        b = data[:n]
        c = self.classes[b]
        two = np.flatnonzero((b == 0xC2) | (b == 0xC3))
        if two.size:
            c[two] = c[two + 1] = self.classes[((b[two] & 3) << 6) | (data[two + 1] & 0x3F)]
        lead = (b & 0xC0) != 0x80
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        before = np.empty(n, np.uint8)
        before[1:] = c[:-1]
        before[first[:n]] = 9
        white = c <= OTHER_SPACE
        if self.words:
            begin = (before != c) | (c == NUMBER)
            apart = before != OTHER
        else:
            after = np.full(n, 9, np.uint8)  # class of the next character
            after[:-1] = c[1:]
            if two.size:
                after[two] = np.append(c, 9)[two + 2]
                last = first[np.minimum(two + 2, n)]
                after[two[last]] = 9
            one = first[1 : n + 1].copy()
            if two.size:
                one[two] = False
            after[one] = 9
            white_before = before <= OTHER_SPACE
            # a run of white space gives up its last character when more text follows
            begin = np.where(white, ~white_before | ((after > OTHER_SPACE) & (after != 9)), (before != c) & (before != SPACE))
            apart = (before != OTHER) & (before != SPACE)
        begin &= lead
        begin[first[:n]] = True
        quote = np.flatnonzero((b == 0x27) & apart)
        if quote.size:
            doc_end = offsets[np.searchsorted(offsets, quote, "right")]
            x, y = data[quote + 1], data[quote + 2]
            one = np.isin(x, np.frombuffer(b"stmd", np.uint8)) & (quote + 1 < doc_end)
            pair = ((x == 0x72) & (y == 0x65)) | ((x == 0x76) & (y == 0x65)) | ((x == 0x6C) & (y == 0x6C))
            pair &= quote + 2 < doc_end
            size = np.where(one, 2, np.where(pair, 3, 0))
            hit = size > 0
            q, stop, lim = quote[hit], (quote + size)[hit], doc_end[hit]
            begin[q] = True
            begin[q + 1] = False
            inside = stop < lim
            stop = stop[inside]
            begin[stop[c[stop] == LETTER]] = True
        start = np.flatnonzero(begin)
        size = np.diff(np.append(start, n))
        if self.words:
            keep = ~white[start]
            start, size = start[keep], size[keep]
        return start, size, c

    def _words_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.words:
            data = data.copy()
            low = (data >= 0x41) & (data <= 0x5A)
            data[low] |= 0x20
            lead = np.flatnonzero(data[:-1] == 0xC3)
            second = data[lead + 1]
            up = lead[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)] + 1
            data[up] += 0x20
        start, size, _ = self.split_plain(data, offsets)
        per_doc = np.diff(np.searchsorted(start, offsets))
        ids, count = self._encode_segments(data, start, size)
        return ids, np.add.reduceat(np.append(count, 0), np.minimum(np.cumsum(per_doc) - per_doc, len(count))) * (per_doc > 0)

    def _encode_segments(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of byte segments: equal words are encoded once."""
        short = size <= 16
        flat = np.lib.stride_tricks.as_strided(data.view(np.uint8), (len(data) - 8,), (1,)).view(np.uint8)
        words8 = np.lib.stride_tricks.as_strided(flat[:8].view(np.uint64), (len(data) - 8,), (1,))
        s, z = start[short], size[short]
        mask = np.append((np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))) - np.uint64(1), np.uint64(2**64 - 1))
        lo = words8[s] & mask[np.minimum(z, 8)]
        hi = words8[s + 8] & mask[np.maximum(z - 8, 0)]
        with np.errstate(over="ignore"):
            h = lo * np.uint64(0x9E3779B97F4A7C15) ^ (hi + np.uint64(31) * z.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        _, at, inv = np.unique(h, return_index=True, return_inverse=True)
        if ((lo[at][inv] != lo) | (hi[at][inv] != hi) | (z[at][inv] != z)).any():
            _, at, inv = np.unique(np.stack([lo, hi, z.astype(np.uint64)], 1), axis=0, return_index=True, return_inverse=True)
            inv = inv.reshape(-1)
        long_at = np.flatnonzero(~short)
        mid = long_at[size[long_at] <= LONG_WORD]
        huge = long_at[size[long_at] > LONG_WORD]
        u_start = np.concatenate([s[at], start[mid]])
        u_size = np.concatenate([z[at], size[mid]])
        back = np.empty(len(start), np.int64)
        back[short] = inv
        back[mid] = len(at) + np.arange(len(mid))
        back[huge] = len(u_start) + np.arange(len(huge))
        own, count = self.encode_words(*self._as_symbols(data, u_start, u_size))
        if huge.size:
            more = [self._encode_long(data[start[i]: start[i] + size[i]]) for i in huge]
            own = np.concatenate([own, *more])
            count = np.concatenate([count, [len(x) for x in more]])
        count = count.astype(np.int64)
        at = np.cumsum(count) - count
        each = count[back]
        return self.ext[own[ragged(at[back], each)]], each

    def _as_symbols(self, data, start, size):
        syms = data[ragged(start, size)].astype(np.int32)
        begin = np.cumsum(size) - size
        if self.suffix and len(size):
            syms[(begin + size - 1)[size > 0]] += 256
        return syms, begin, size

    def _encode_long(self, word: np.ndarray) -> np.ndarray:
        """One long word, the same steps in plain Python (still linear)."""
        syms = word.astype(np.int32)
        if self.suffix:
            syms[-1] += 256
        n = len(word)
        longest = self._walk(syms.tolist())
        known: dict[int, bool] = {}
        length, shorter = self.length, self.shorter
        free, out, pos, tok = bytearray(b"\1" * (n + 1)), [], 0, longest[0]
        while pos < n:
            e = pos + int(length[tok])
            ok = bool(free[e])
            if ok and out:
                key = out[-1] * self.n + tok
                ok = known.get(key)
                if ok is None:
                    ok = known[key] = bool(self._compatible(np.array([out[-1]]), np.array([tok]))[0])
            if ok:
                out.append(tok)
                pos = e
                tok = longest[pos] if pos < n else -1
                continue
            tok = int(shorter[tok])
            if tok < 0:
                free[pos] = 0
                tok = out.pop()
                pos -= int(length[tok])
        return np.array(out, np.int32)

    def _walk(self, syms: list[int]) -> list[int]:
        """Longest token at every symbol of one word."""
        goto, fail, token_at, inner = self.goto, self.fail, self.token_at, self.inner
        best, state = [0] * len(syms), 0
        for i in range(len(syms) - 1, -1, -1):
            s = syms[i]
            while True:
                to = goto[state, s] if state < inner else -1
                if to >= 0:
                    state = to
                    break
                if not state:
                    break
                state = fail[state]
            best[i] = int(token_at[state])
        return best

    def _ids_other(self, text: str) -> np.ndarray:
        """Texts with other scripts, control characters or special tokens: split by the library."""
        import regex
        if self._lib is None:
            from tokenizers import Tokenizer
            self._lib = Tokenizer.from_file(self.path)
        lib, parts = self._lib, []
        names = sorted(self.special, key=len, reverse=True)
        pieces = regex.split("(" + "|".join(map(regex.escape, names)) + ")", text) if names else [text]
        for piece in pieces:
            if piece in self.special:
                parts.append(np.array([self.special[piece]], np.uint32))
            elif piece:
                norm = lib.normalizer.normalize_str(piece) if lib.normalizer else piece
                words = [bytes(self.byte_of[ch] for ch in w) for w, _ in lib.pre_tokenizer.pre_tokenize_str(norm)]
                if words:
                    size = np.array([len(w) for w in words], np.int64)
                    data = np.frombuffer(b"".join(words) + bytes(24), np.uint8)
                    parts.append(self._encode_segments(data, np.cumsum(size) - size, size)[0])
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and their number per text (null: 0)."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
        ids, counts = [], np.zeros(len(texts), np.int64)
        for doc, data, offsets in _chunks(raw, off):
            n = int(offsets[-1])
            odd_byte = (data[:n] >= 0xC4) | ((data[:n] < 0x20) & ~np.isin(data[:n], (9, 10, 13))) | (data[:n] == 0x7F)
            odd_byte |= (data[:n] == 0xC2) & (data[1: n + 1] < 0xA0)
            odd_byte |= (data[:n] == 0x3C) & (data[1: n + 1] == 0x7C)
            seen = np.concatenate([[0], np.cumsum(odd_byte)])
            odd = seen[offsets[1:]] > seen[offsets[:-1]]
            if not odd.any():
                got, per = self._words_plain(data, offsets)
                ids.append(got)
            else:
                size = np.diff(offsets)
                plain = np.flatnonzero(~odd)
                sub = np.append(data[ragged(offsets[plain], size[plain])], np.zeros(24, np.uint8))
                got, n_got = self._words_plain(sub, np.concatenate([[0], np.cumsum(size[plain])])) if plain.size else (np.empty(0, np.uint32), np.empty(0, np.int64))
                per = np.zeros(len(size), np.int64)
                per[plain] = n_got
                split = iter(np.split(got, np.cumsum(n_got)[:-1]) if plain.size else [])
                rows = []
                for i in range(len(size)):
                    if odd[i]:
                        rows.append(self._ids_other(data[offsets[i]: offsets[i + 1]].tobytes().decode("utf-8", "replace")))
                        per[i] = len(rows[-1])
                    else:
                        rows.append(next(split))
                ids.append(np.concatenate(rows) if rows else np.empty(0, np.uint32))
            np.add.at(counts, doc, per)
        return (np.concatenate(ids) if ids else np.empty(0, np.uint32)).astype(np.uint32), counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 text of each segment of ids."""
        lens = np.diff(self.off)[ids]
        data = self.blob[ragged(self.off[ids], lens)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lens)])
        cut = ends[np.concatenate([[0], np.cumsum(counts)])]
        if self.joined:  # without the space after the last token
            return [data[a: max(a, b - 1)] for a, b in zip(cut[:-1], cut[1:])]
        return [data[a:b].decode("utf-8", "replace").encode() for a, b in zip(cut[:-1], cut[1:])]


def _chunks(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of at most about CHUNK_BYTES: text numbers, bytes with padding, borders from 0."""
    n = len(off) - 1
    i = 0
    while i < n:
        if off[i + 1] - off[i] > CHUNK_BYTES:
            a, end = int(off[i]), int(off[i + 1])
            while a < end:
                e = _safe_cut(raw, a, end)
                yield np.array([i]), _padded(raw, a, e), np.array([0, e - a])
                a = e
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK_BYTES, "right")) - 1)
        yield np.arange(i, j), _padded(raw, int(off[i]), int(off[j])), (off[i: j + 1] - off[i]).astype(np.int64)
        i = j


def _padded(raw: np.ndarray, a: int, e: int) -> np.ndarray:
    out = np.zeros(e - a + 24, np.uint8)
    out[: e - a] = raw[a:e]
    return out


def _cut_marks() -> tuple[np.ndarray, np.ndarray]:
    """Bytes after which, before a letter, a new word starts in every pattern: digits and ASCII marks.

    No quote (it may begin "'s") and none of the marks of special tokens.
    """
    marks = np.zeros(256, bool)
    marks[[c for c in range(33, 127) if not chr(c).isalpha() and chr(c) not in "'<|>"]] = True
    letters = np.zeros(256, bool)
    letters[[c for c in range(128) if chr(c).isalpha()]] = True
    return marks, letters


_MARKS, _LETTERS = _cut_marks()
# Full stops, commas and the like of Chinese and Japanese, in UTF-8.
CJK_MARKS = [x.encode() for x in "。，、！？；："]


def _safe_cut(raw: np.ndarray, a: int, end: int) -> int:
    """The first place after CHUNK_BYTES where a new word starts whatever is around it, or the end.

    That is a space or line feed between two ASCII letters, a letter after a digit or ASCII mark,
    or a Chinese character after a Chinese mark.
    """
    at = a + CHUNK_BYTES
    while at < end - 1:
        b = raw[at: min(at + CHUNK_BYTES, end)]
        if len(b) < 4:
            break
        letter = _LETTERS[b]
        hit = np.zeros(len(b), bool)
        hit[1:-1] = ((b[1:-1] == 0x20) | (b[1:-1] == 0x0A)) & letter[:-2] & letter[2:]
        hit[1:] |= _MARKS[b[:-1]] & letter[1:]
        for x in CJK_MARKS:
            hit[3:] |= (b[:-3] == x[0]) & (b[1:-2] == x[1]) & (b[2:-1] == x[2]) & (b[3:] >= 0xE4) & (b[3:] <= 0xE9)
        found = np.flatnonzero(hit)
        if found.size:
            return at + int(found[0])
        at += max(len(b) - 4, 1)
    return end


def load(path: str) -> Bpe:
    """Tables of a vocabulary file, built once per Python worker.

    The functions of this module reach a worker by value, anew with every task, so
    the tables are kept under a name of their own.
    """
    kept = sys.modules.setdefault("_sitelens_vocabularies", types.ModuleType("_sitelens_vocabularies")).__dict__
    if path not in kept:
        kept[path] = Bpe(path)
    return kept[path]


def _add_columns(batch: pa.RecordBatch, new: dict[str, pa.Array], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n not in drop}
    return pa.RecordBatch.from_pydict(cols | new)


def encode_documents(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with ``ids`` (array<int>) in place of a column of that name."""
    schema = T.StructType([f for f in df.schema.fields if f.name != ids] + [T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches):
        bpe = load(path)
        for batch in batches:
            got, per = bpe.encode(batch.column(text))
            off = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
            yield _add_columns(batch, {ids: pa.ListArray.from_arrays(pa.array(off), pa.array(got.astype(np.int32)))}, (ids,))

    return df.mapInArrow(run, schema)


def decode_documents(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with ``text`` decoded from ``ids`` (null ids: the empty text)."""
    schema = T.StructType([f for f in df.schema.fields if f.name != text] + [T.StructField(text, T.StringType())])

    def run(batches):
        bpe = load(path)
        for batch in batches:
            col = batch.column(ids)
            flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            per = np.diff(col.offsets.to_numpy()) if col.null_count == 0 else np.array([len(x) if x is not None else 0 for x in col.to_pylist()], np.int64)
            yield _add_columns(batch, {text: pa.array([x.decode() for x in bpe.decode(flat, per)], pa.string())}, (text,))

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, then decode, every text: counts and digests of both.

    Columns: key, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit
    integers), decoded_sha256, decoded_bytes.  A null text counts as empty.
    """
    schema = T.StructType([df.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType()), T.StructField("decoded_bytes", T.LongType())])

    def run(batches):
        bpe = load(path)
        for batch in batches:
            keys, texts = batch.column(key), batch.column(text)
            for a, e in row_slices(texts):
                got, per = bpe.encode(texts.slice(a, e - a))
                raw, cut = got.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(per)]) * 4
                plain = bpe.decode(got.astype(np.int64), per)
                yield pa.RecordBatch.from_pydict({
                    key: keys.slice(a, e - a), "n_tokens": pa.array(per, pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(cut[:-1], cut[1:])], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in plain], pa.string()),
                    "decoded_bytes": pa.array([len(x) for x in plain], pa.int64())})

    return df.select(key, text).mapInArrow(run, schema)


def row_slices(texts: pa.Array, limit: int = 2 * CHUNK_BYTES, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``rows`` rows and about ``limit`` bytes of text (a longer row alone)."""
    off = np.frombuffer(texts.buffers()[1], np.int32 if texts.type in (pa.string(), pa.binary()) else np.int64)
    off = off[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    i, n = 0, len(texts)
    while i < n:
        j = min(i + rows, max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1))
        yield i, j
        i = j
