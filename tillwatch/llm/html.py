"""Main text of web pages by template deduction from equivalence classes.

Structural tokens are tags with their path of open elements, their class, id and role; a text token is a
block's text at its path.  Tokens of one host with the same occurrence vector (how often they stand in
each of the host's pages) form a class, if they stand in two pages and a share of the host's; a host may have
several templates.  Classes are ordered and nested: a token that stands before one of its class on a page and
after it by the class's order becomes a class alone, and a class is split by the gaps (the last token before, of
the class around it) it stands in.  Other tokens are then told apart by the gap they and their parents stand in,
so that the second `div` of a page may be another token than the first, and the classes are found anew, until
no token and no class changes.

A slot is an article, main or container of a class that stands once in each page that has it, with at least
half of those pages' main text below it; one that rounds told apart from others of its path must hold all text
but template, which is text on all pages of its element.  Each page takes, of the slots it holds, the outermost
article or main, else the deepest container, or the outermost one told apart in it; an article or main of its own
goes before a container that is the body or mostly that article.  Nothing in a slot goes because it repeats
(headings of recipes do).

Pages are walked once into token sequences, which the rounds read.  Vectors are compared by a linear fingerprint,
the sum of page hash times count, so they aggregate before the shuffle and a host of any size is one row per token.

A page without a slot (or the only page of its host) falls back to its own article, main or body.  Within
the slot, elements that are never content by their name or by a whole class, id or role go; what is left
is text blocks.  No class marks html, body, main, article, the slot or what is around it.

Defined results: null and empty pages have empty text; rows without a url are one host of their own;
truncated markup ends where it is cut; repeated rows are repeated; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.shared import BROADCAST_ROWS, discard, small, stored

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]++|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|<(?=[/!?a-zA-Z])[^<]*$", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: without these no attribute has a name that counts
_NAMED = re.compile("class|id|role|hidden", re.I)
#: elements without an end
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: elements that never hold main text
ASIDE = set("head title script style noscript template nav header footer aside form button select option textarea input iframe object svg canvas audio video dialog menu map".split())
#: elements that hold blocks and may be a slot
CONTAINERS = set("article main section div body td center".split())
#: 2 an article or main, 1 another container
KINDS = {tag: 2 if tag in ("article", "main") else 1 for tag in CONTAINERS}
#: elements whose content is no markup
RAW = set("script style textarea title noscript iframe".split())
#: elements inside a line of text
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr math mi mn mo mrow ms mtext msup msub msubsup mfrac msqrt mroot mover munder munderover semantics".split())
#: elements that close an open paragraph
CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: elements that are never marked
PROTECTED = set("html body main article".split())
#: classes, ids and roles, as whole names, that mark what is no main text
MARKS = set(
    "ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer masthead "
    "cookie cookies consent notice notices gdpr popup modal overlay comment comments disqus reply replies share sharing social related recommended subscribe newsletter signup login "
    "search pagination pager toolbar widget complementary contentinfo "
    "share-box share-bar share-buttons social-share cookie-banner cookie-notice site-header site-footer page-footer comment-list comments-area related-posts related-articles".split()
)


def _names(attributes: str) -> tuple[str, bool]:
    """Class, id and role as text, and whether the element is marked as no main text."""
    kept, marked = [], False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            value = next((v for v in values if v), "")
            kept.append(f"{name}={value}")
            marked = marked or any(w.lower() in MARKS for w in value.split())
        elif name == "hidden":
            marked = True
    return " ".join(sorted(kept)), marked


@lru_cache(maxsize=16_384)
def _path(above: int, step: str) -> int:
    """The hash of an element's path.  The pages of a host share most of theirs."""
    return hash_text(f"{above}/{step}")


#: characters of a step (tag, class, id and role) whose path is kept
KEPT_STEP = 256


class Page:
    """Walks a page once: elements with their paths, and text with its place."""

    def __init__(self, source: str):
        #: elements in page order; text: (element index, text or None for a block's edge, elements opened before)
        self.paths: list[int] = []
        self.parents: list[int] = []
        self.tags: list[str] = []
        self.text: list[tuple[int, str | None, int]] = []
        self.marked: list[bool] = []
        paths, parents, tags, text, marks, open_ = self.paths, self.parents, self.tags, self.text, self.marked, []
        at, end = 0, len(source)
        while at < end:
            found = _TOKEN.search(source, at)
            stop = found.start() if found else end
            if stop > at:
                text.append((open_[-1] if open_ else -1, source[at:stop], len(tags)))
            if not found:
                break
            at = found.end()
            closing, tag, attributes = found.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                if open_ and tags[open_[-1]] == tag:
                    k = open_.pop()
                    if tag not in INLINE:
                        text.append((k, None, len(tags)))
                else:
                    self._close(open_, tag)
                continue
            if tag in CLOSES_P:
                self._close_p(open_)
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and open_ and tags[open_[-1]] == tag:
                self._close(open_, tag)
            names, marked = _names(attributes) if attributes and _NAMED.search(attributes) else ("", False)
            parent, k, step = open_[-1] if open_ else -1, len(tags), f"{tag} {names}"
            paths.append((_path if len(step) <= KEPT_STEP else _path.__wrapped__)(paths[parent] if parent >= 0 else 0, step))
            parents.append(parent), tags.append(tag), marks.append(marked and tag not in PROTECTED)
            if tag not in INLINE:
                text.append((k, None, k + 1))
            elif tag == "br":
                text.append((k, " ", k + 1))
            if tag in RAW:
                close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
                at = close.start() if close else end
                open_.append(k)
            elif tag not in VOID and not attributes.endswith("/"):
                open_.append(k)
        self._unmark()
        self._settle()

    def _say(self, k: int, text: str | None) -> None:
        self.text.append((k, text, len(self.tags)))

    def _unmark(self) -> None:
        """A mark does not hold where all articles and mains of the page, or on a page without one at least half of its text, stand below it."""
        if not any(self.marked):
            return
        never, chars, stories = self._inherited([t in ASIDE for t in self.tags]), [0] * len(self.tags), [0] * len(self.tags)
        for k, text, _ in self.text:
            if text is not None and k >= 0 and not never[k]:
                chars[k] += len(text)
        for k, tag in enumerate(self.tags):
            stories[k] = int(tag in ("article", "main") and not never[k])
        every, some = sum(chars), any(stories)
        aside = self._inherited(self.marked) if some else []
        lost = some and all(aside[k] for k, n in enumerate(stories) if n)
        if some and not lost:
            return
        for k in range(len(self.tags) - 1, -1, -1):
            if self.parents[k] >= 0:
                chars[self.parents[k]] += chars[k]
                stories[self.parents[k]] += stories[k]
            if lost and stories[k] or not some and every and 2 * chars[k] >= every:
                self.marked[k] = False

    def _inherited(self, own: list[bool]) -> list[bool]:
        out: list[bool] = []
        for mark, parent in zip(own, self.parents):
            out.append(mark or parent >= 0 and out[parent])
        return out

    def _settle(self) -> None:
        """aside: inside an element that is never main text or is marked."""
        self.aside = self._inherited([t in ASIDE or m for t, m in zip(self.tags, self.marked)])

    def _close(self, open_: list[int], tag: str) -> None:
        for k in range(len(open_) - 1, -1, -1):
            if self.tags[open_[k]] == tag:
                if tag not in INLINE:
                    self._say(open_[k], None)
                del open_[k:]
                return
            # an inline end tag never closes a block around it
            if tag in INLINE and self.tags[open_[k]] not in INLINE:
                return

    def _close_p(self, open_: list[int]) -> None:
        for k in range(len(open_) - 1, -1, -1):
            tag = self.tags[open_[k]]
            if tag == "p":
                self._say(open_[k], None)
                del open_[k:]
                return
            if tag not in INLINE:
                return

    def _below(self) -> list[int]:
        """Characters of main text below each element, and last those of the page."""
        chars = [0] * (len(self.tags) + 1)
        for k, text, _ in self.text:
            if text is not None and (k < 0 or not self.aside[k]):
                chars[k] += len(text)
        for k in range(len(self.tags) - 1, -1, -1):
            chars[self.parents[k]] += chars[k]  # that of the page, if there is no parent
        return chars

    def _blocks(self, inside: list[bool] | None = None) -> list[tuple[int, int, str]]:
        """(element or -1, elements opened before, text) of the blocks of main text: all, or those inside and what
        stands in no element if nothing is."""
        blocks, line, at, place, blank = [], [], -1, 0, True
        if inside is None:
            taken = [not out for out in self.aside]
        else:
            taken = [one and not out for one, out in zip(inside, self.aside)]
        taken.append(inside is None or not any(inside))  # what stands in no element: -1
        for k, text, before in [*self.text, (-1, None, 0)]:
            if text is None:
                if not blank:
                    block = " ".join(html.unescape("".join(line)).split())
                    if block:
                        while at >= 0 and self.tags[at] in INLINE:
                            at = self.parents[at]
                        blocks.append((at, place, block))
                if line:
                    line, at, blank = [], -1, True
            elif taken[k]:
                if blank or at < 0:
                    at, place = k, before
                    blank = blank and text.isspace()
                line.append(text)
        return blocks

    def walk(self) -> tuple[list[int], list[int], list[int], list[int], list[int], int]:
        """tokens in page order, the places of their parents or -1, kinds, characters of main text below, depths, and
        the page's characters.  Kinds: 2 an article or main, 1 a container, 0 another element, -1 a block's text."""
        chars = self._below()
        tokens, parents, kinds, sizes, depths, places = [], [], [], [], [], []
        blocks, paths = self._blocks(), self.paths
        blocks.append((-1, len(paths) + 1, ""))  # behind all
        b, (at, place, block) = 0, blocks[0]
        for k in range(len(paths) + 1):
            while place <= k:
                tokens.append(hash_text(f"{paths[at] if at >= 0 else 0} {block}"))
                parents.append(places[at] if at >= 0 else -1)
                kinds.append(-1), sizes.append(len(block)), depths.append(0)
                b += 1
                at, place, block = blocks[b]
            if k < len(paths):
                parent = self.parents[k]
                above = places[parent] if parent >= 0 else -1
                depths.append(depths[above] + 1 if above >= 0 else 1)
                places.append(len(tokens))
                tokens.append(paths[k]), parents.append(above), sizes.append(chars[k])
                kinds.append(0 if self.aside[k] else KINDS.get(self.tags[k], 0))
        return tokens, parents, kinds, sizes, depths, chars[-1]

    def roles(self, rounds: list[dict[int, tuple[int, int]]]) -> list[set[int]]:
        """The elements' tokens, before and after each round."""
        tokens, parents, kinds, *_ = self.walk()
        found = [{t} for t in tokens]
        for classes in rounds:
            tokens = refine(tokens, parents, classes)[0]
            for one, t in zip(found, tokens):
                one.add(t)
        return [one for one, kind in zip(found, kinds) if kind >= 0]

    @staticmethod
    def choose(slots: list[dict], here: set[int]) -> dict | None:
        """Of the host's slots the outermost article or main of this page, else its deepest container or what is told apart in it."""
        held = [s for s in slots if s["token"] in here]
        named = [s for s in held if s["content"] == 2]
        if named:
            return min(named, key=lambda s: (s["depth"], s["token"]))
        slot = max((s for s in held if not s["token"] & 1), key=lambda s: (s["depth"], s["token"]), default=None)
        # what rounds told apart holds all but template: below that slot, the outermost
        told = [s for s in held if s["token"] & 1 and (slot is None or s["depth"] > slot["depth"])]
        return min(told, key=lambda s: (s["depth"], s["token"]), default=slot)

    def _inside(self, roots: set[int]) -> list[bool]:
        return self._inherited([k in roots for k in range(len(self.tags))])

    def extract(self, slots: list[dict], rounds: list[dict[int, tuple[int, int]]]) -> str:
        """Blocks of main text inside the page's slot."""
        # a slot whose token no round changed is known by its path
        if any(s["token"] & 1 for s in slots):
            here = self.roles(rounds)
            slot = self.choose(slots, set().union(*here))
            found = [k for k, tokens in enumerate(here) if slot["token"] in tokens] if slot else []
        else:
            slot = self.choose(slots, set(self.paths))
            found = [k for k, token in enumerate(self.paths) if token == slot["token"]] if slot else []
        marked = False
        for k in found:  # a slot and what is around it is not marked
            while k >= 0:
                marked = marked or self.marked[k]
                self.marked[k], k = False, self.parents[k]
        if marked:
            self._settle()
        roots = {k for k in found if not self.aside[k]}
        if roots and slot["content"] == 1:
            # an article or main of the page's own: before body, or if it has most of the slot's text
            inside, chars = self._inside(roots), self._below()
            body = all(self.tags[k] == "body" for k in roots)
            for tag in ("article", "main"):
                own = {k for k, t in enumerate(self.tags) if t == tag and inside[k] and not self.aside[k]}
                outer = self._inside(own)
                size = sum(chars[k] for k in own if self.parents[k] < 0 or not outer[self.parents[k]])
                if own and size and (body or 2 * size >= sum(chars[k] for k in roots)):
                    roots = own
                    break
        for tag in ("article", "main", "body"):
            if not roots:
                roots = {k for k, t in enumerate(self.tags) if t == tag and not self.aside[k]}
        return "\n".join(block for *_, block in self._blocks(self._inside(roots)))


#: share of a host's pages that a class needs, besides two pages
SUPPORT = 0.005


def hash_text(text: str) -> int:
    """A 63-bit hash that is the same in every process; even, as a round's tokens are odd."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") >> 1 & ~1


def nesting(tokens: list[int], parents: list[int], classes: dict[int, tuple[int, int]]) -> tuple[list[int], list[int]]:
    """For each place of a page, by the host's token -> (class, rank): its gap, the last token of its parent's class
    before it (0 in that class itself), and its nest, the gap of the class around it that its own class stands in."""
    gaps, nests, last, owns = [], [], {}, []
    for token, p in zip(tokens, parents):
        found = classes.get(token)
        own = found[0] if found else None
        outer = owns[p] if p >= 0 else None
        owns.append(own)
        if outer is None or own == outer:
            gaps.append(0), nests.append(0 if outer is None else nests[p])
        else:
            gap = last[outer]
            # hashes of whole numbers are the same in every process
            gaps.append(0 if own is None else gap), nests.append(hash((outer, gap)))
        if own is not None:
            last[own] = token
    return gaps, nests


def disordered(tokens: list[int], parents: list[int], classes: dict[int, tuple[int, int]]) -> set[int]:
    """Tokens that stand before or after one of their class against the class's order on this page.

    A class that repeats in the page repeats as a whole, within each of the gaps it stands in.
    """
    groups: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    last: dict[tuple[int, int], tuple[int, int]] = {}
    nth = _nth(tokens)
    most, nests = dict(zip(tokens, nth)), nesting(tokens, parents, classes)[1]
    for token, nest, n in zip(tokens, nests, nth):
        found = classes.get(token)
        if found and found[1] >= 0:
            group, place = (found[0], nest if most[token] > 1 else 0), (n, found[1])
            if last.get(group, place) > place:
                break
            last[group] = place
    else:
        return set()  # most pages are in order
    for token, nest, n in zip(tokens, nests, nth):
        if token in classes and classes[token][1] >= 0:
            groups.setdefault((classes[token][0], nest if most[token] > 1 else 0), []).append((n, classes[token][1], token))
    out = set()
    for found in groups.values():
        if all(a < b for a, b in zip(found, found[1:])):
            continue
        greatest, least = found[0], found[-1]
        for after, before in zip(found, reversed(found)):
            greatest, least = max(greatest, after), min(least, before)
            if after < greatest:
                out.add(after[2])
            if before > least:
                out.add(before[2])
    return out


def refine(tokens: list[int], parents: list[int], classes: dict[int, tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Tokens told apart by their gap and their parent's, and nests."""
    gaps, nests = nesting(tokens, parents, classes)
    out: list[int] = []
    for token, p, gap in zip(tokens, parents, gaps):
        above = p >= 0 and out[p] != tokens[p]
        out.append(hash((token, out[p], gap)) | 1 if token and (gap or above) else token)
    return out, nests


def varying(tokens: list[int], parents: list[int], sizes: list[int], classes: dict[int, tuple[int, int, int]]) -> list[int]:
    """Characters at and below each place, of texts (those with a size) that do not stand on all pages of their element's token."""
    out = [0] * len(tokens)
    for k in range(len(tokens) - 1, -1, -1):
        p = parents[k]
        above = classes.get(tokens[p]) if p >= 0 else None
        if not (tokens[k] in classes and above and classes[tokens[k]][2] >= above[2]):
            out[k] += sizes[k]
        if p >= 0:
            out[p] += out[k]
    return out


def _host() -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


_WALK = {"host": ("string", pa.string()), "page": ("long", pa.int64()), "page_chars": ("long", pa.int64()), "page_data": ("long", pa.int64())}
_WALK |= {c: (f"array<{t}>", pa.list_(k)) for c, t, k in (("parents", "int", pa.int32()), ("kinds", "int", pa.int32()), ("chars", "long", pa.int64()), ("depths", "int", pa.int32()))}
_WALK |= {c: (f"array<{t}>", pa.list_(k)) for c, t, k in (("tokens", "long", pa.int64()), ("nests", "long", pa.int64()), ("nth", "int", pa.int32()), ("alone", "int", pa.int32()), ("data", "long", pa.int64()))}
WALK = ", ".join(f"{c} {t}" for c, (t, _) in _WALK.items())


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, _WALK[c][1]) for c, v in columns.items()], names=list(columns))


def _nth(tokens: list[int]) -> list[int]:
    """Which occurrence of its token in the page each is, from 1."""
    times: dict[int, int] = {}
    out = []
    for token in tokens:
        times[token] = times.get(token, 0) + 1
        out.append(times[token])
    return out


def _lists(column: pa.ListArray) -> list[list[int]]:
    values, at, out = column.flatten().to_numpy(zero_copy_only=False).tolist(), 0, []
    for n in column.value_lengths().to_pylist():
        out.append(values[at : at + n])
        at += n
    return out


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {c: [] for c in _WALK}
        for host, key, source in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "html"))):
            tokens, parents, kinds, chars, depths, page_chars = Page(source).walk()
            none = [0] * len(tokens)
            for c, v in zip(out, (host, key, page_chars, page_chars, parents, kinds, chars, depths, tokens, none, _nth(tokens), none, chars)):
                out[c].append(v)
        yield _batch(out)


#: tokens of hosts that a task keeps unpacked
UNPACKED = 500_000


class _Classes:
    """The hosts' classes as dictionaries, unpacked once in a task as long as they are few."""

    def __init__(self) -> None:
        self.found: dict[str, dict[int, tuple[int, int]]] = {}
        self.size = 0

    def of(self, host: str, packed: pa.Scalar) -> dict[int, tuple[int, int]]:
        if host not in self.found:
            values = packed.values.to_numpy(zero_copy_only=False).tolist() if packed.is_valid else []
            if self.size > UNPACKED:
                self.found, self.size = {}, 0
            self.found[host] = dict(zip(values[::4], zip(values[1::4], values[2::4], values[3::4])))
            self.size += len(values) // 4
        return self.found[host]


def _disordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Classes()
    for batch in batches:
        found: set[tuple[str, int]] = set()
        packed = batch.column("classes")
        for k, (host, tokens, parents) in enumerate(zip(batch.column("host").to_pylist(), _lists(batch.column("tokens")), _lists(batch.column("parents")))):
            found |= {(host, t) for t in disordered(tokens, parents, known.of(host, packed[k]))}
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.string()), pa.array([t for _, t in found], pa.int64())], names=["host", "token"])


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Classes()
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("page_data", "tokens", "nests", "nth", "alone", "data")}
        packed = batch.column("classes")
        rows = zip(batch.column("host").to_pylist(), *(_lists(batch.column(c)) for c in ("tokens", "parents", "kinds", "chars")))
        for k, (host, tokens, parents, kinds, chars) in enumerate(rows):
            classes = known.of(host, packed[k])
            data = varying(tokens, parents, [n if kind < 0 else 0 for n, kind in zip(chars, kinds)], classes)
            # a text below the support is in no later class
            tokens = [t if kind >= 0 or t in classes else 0 for t, kind in zip(tokens, kinds)]
            new, nests = refine(tokens, parents, classes)
            for c, v in zip(out, (sum(n for n, p in zip(data, parents) if p < 0), new, nests, _nth(new), [int(t in classes and classes[t][1] < 0) for t in tokens], data)):
                out[c].append(v)
        yield _batch({c: out[c] if c in out else batch.column(c) for c in _WALK})


def page_walks(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """The tokens of each page in page order, with the places of their parents."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html")).filter("html is not null")
    return rows.select(_host().alias("host"), F.xxhash64("page_id", "url").alias("page"), "html").mapInArrow(_walks, WALK)


def token_vectors(walks: DataFrame) -> DataFrame:
    """host, token, and of its occurrences: pages, number, vector fingerprint, most in a page, characters, those of
    the pages, varying ones of both, depth, content, sum of places, nest, whether it is alone."""
    rows = walks.select("host", "page", "page_chars", "page_data", F.posexplode(F.arrays_zip("tokens", "kinds", "chars", "depths", "nests", "nth", "alone", "data")).alias("pos", "t"))
    rows = rows.select("host", "page", "page_chars", "page_data", "pos", "t.*").filter("tokens != 0")
    # sums wrap, as a fingerprint may: decimal sums are cut to 64 bits
    wrapped = F.sum(F.col("page").cast("decimal(38,0)")) % F.lit(2**61 - 1).cast("decimal(38,0)")
    first = F.col("nth") == 1
    return rows.groupBy("host", F.col("tokens").alias("token")).agg(
        F.sum(first.cast("long")).alias("pages"), F.count(F.lit(1)).alias("number"), wrapped.cast("long").alias("vector"), F.max("nth").alias("most"),
        F.sum("chars").alias("chars"), F.sum(F.when(first, F.col("page_chars")).otherwise(0)).alias("page_chars"), F.max("depths").alias("depth"),
        F.sum("data").alias("data"), F.sum(F.when(first, F.col("page_data")).otherwise(0)).alias("page_data"), F.min("kinds").alias("content"),
        F.sum(F.col("pos").cast("long")).alias("places"), F.min("nests").alias("nest"), F.max("alone").alias("alone"),
    )


def equivalence_classes(vectors: DataFrame, share: float = SUPPORT) -> DataFrame:
    """vectors above the support, with class and rank.  A class: tokens of a host with one occurrence vector in one
    gap of the class around them; its tokens are ranked by their places.  A token out of order is a class alone."""
    top = vectors.filter("content >= 0").groupBy("host").agg(F.max("pages").alias("host_pages"))
    # hosts are broadcast, so that a large one's tokens do not meet in a task
    kept = vectors.filter("pages > 1").join(small(top), "host").filter(F.col("pages") >= F.greatest(F.lit(2), F.ceil(F.col("host_pages") * share)))
    kept = kept.withColumn("class", F.xxhash64("vector", "nest", F.when(F.col("alone") > 0, F.col("token"))))
    rank = F.row_number().over(Window.partitionBy("host", "class").orderBy("places", "token")).cast("long")
    return kept.withColumn("rank", F.when(F.col("alone") > 0, F.lit(-1).cast("long")).otherwise(rank))


def _packed(classes: DataFrame) -> DataFrame:
    """host, classes: token, class, rank and pages of each token in one array."""
    return classes.groupBy("host").agg(F.flatten(F.collect_list(F.array("token", "class", "rank", "pages"))).alias("classes"))


def _with(rows: DataFrame, hosts: DataFrame, size: int) -> DataFrame:
    """rows with what their host has: broadcast, if the hosts have few enough numbers in all."""
    return rows.join(F.broadcast(hosts) if size <= BROADCAST_ROWS else hosts, "host", "left")


def page_classes(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> tuple[list[DataFrame], list[DataFrame], int]:
    """Each round's tokens with class and rank, what it told apart by host, and the number of tokens in them.

    A round finds the classes, takes out what is not in their order, and tells tokens apart by the gap they stand in;
    the rounds end when that changes no token and no class.
    """
    walks = stored(page_walks(pages, page_id, url, source), "walks")
    found, rounds, size, before = [], [], 0, None
    while True:
        vectors = stored(token_vectors(walks).filter((F.col("content") >= 0) | (F.col("pages") > 1)), "vectors")
        classes = stored(equivalence_classes(vectors), "classes")
        found.append(classes)
        now = tuple(classes.agg(F.count(F.lit(1)), F.sum("number"), F.countDistinct("host", "class"), F.sum("alone")).first())
        discard(vectors)
        if now == before or not now[0]:
            discard(walks)
            return found, rounds, size
        before, size = now, size + now[0]
        first = _with(walks.select("host", "tokens", "parents"), _packed(classes), now[0])
        wrong = stored(first.mapInArrow(_disordered, "host string, token long").distinct(), "wrong")
        # what is taken out leaves the others of its class as they are
        ordered = classes.join(wrong.withColumn("out", F.lit(True)), ["host", "token"], "left").select(
            "host", "token", F.when(F.col("out"), F.xxhash64("class", "token")).otherwise(F.col("class")).alias("class"),
            F.when(F.col("out"), F.lit(-1).cast("long")).otherwise(F.col("rank")).alias("rank"), "pages",
        )
        rounds.append(stored(_packed(ordered), "round"))
        refined = stored(_with(walks, rounds[-1], now[0]).mapInArrow(_refined, WALK), "walks")
        discard(walks, wrong)
        walks = refined


def host_slots(found: list[DataFrame]) -> DataFrame:
    """host, slots: token, content, depth of every container that may be a slot, by the classes of any round.

    A slot is of a class above the support and stands once in each page that has it.  It has at least half of those
    pages' main text below it; one that rounds told apart from others of its path must have all text that varies.
    A slot that is told apart stays, for pages whose part falls below the support.  At most (1 / share) * depth
    tokens of a host and round can be slots.
    """
    half = (F.col("chars") * 2 >= F.col("page_chars")) & (F.col("page_chars") > 0)
    whole = F.when(F.col("token").bitwiseAND(1) == 0, half).otherwise((F.col("data") == F.col("page_data")) & (F.col("data") > 0))
    valid = reduce(DataFrame.unionByName, found).filter("content > 0 and most = 1").filter(whole)
    valid = valid.groupBy("host", "token").agg(F.min("content").alias("content"), F.max("depth").alias("depth"))
    return valid.groupBy("host").agg(F.collect_list(F.struct("token", "content", "depth")).alias("slots"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: list[_Classes] = []
    for batch in batches:
        texts = []
        packed = [batch.column(c) for c in batch.schema.names if c.startswith("round_")]
        known = known or [_Classes() for _ in packed]
        slots: dict[str, list[dict]] = {}  # read once for a host of the batch
        for k, (host, s) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("host", "html")))):
            if host not in slots:
                slots[host] = batch.column("slots")[k].as_py() or []
            texts.append(Page(s).extract(slots[host], [one.of(host, column[k]) for one, column in zip(known, packed)]) if s else "")
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    found, rounds, size = page_classes(pages, page_id, url, source)
    slots = host_slots(found)
    # only hosts with a slot that a round told apart need their rounds
    told = slots.filter(F.exists("slots", lambda s: s["token"].bitwiseAND(1) == 1)).select("host")
    for k, one in enumerate(rounds):
        slots = slots.join(one.join(told, "host", "left_semi").withColumnRenamed("classes", f"round_{k}"), "host", "left")
    slots = stored(slots, "slots")
    discard(*found, *rounds)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html")).withColumn("host", _host())
    return _with(rows, slots, size).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
