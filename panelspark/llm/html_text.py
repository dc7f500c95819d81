"""Main text of web pages: tag roles for the blocks of a page, shared runs of tokens of each host for its boilerplate.

A page is cut into blocks of text, each with a role: inside the article, in page furniture (menus, headers, footers,
sidebars, notices, adverts, forms, comments), or open. The tokens outside articles are concatenated by host
within an Arrow batch, and the suffixes of that stream, sorted by their first DEPTH tokens, tell which runs of DEPTH or
more tokens its pages share. Batches meet by hashes of such prefixes: tasks pass on one row for each prefix, with the first and last page that have
it; a prefix with two different pages is shared, and the positions it covers are counted.

Boilerplate is what SEVERAL distinct pages of a host share. Copies count as one page: equal ones by a hash of their
tokens in the article and in open blocks, near ones by the runs of these tokens, most of which they share. Only
prefixes that some undecided page has, one without an article or with an element in doubt, are looked into; where there
are none, this costs nothing.

Text: the article's blocks; on a page without an article the open blocks that boilerplate does not mostly cover, or all
of them if nothing else would remain. Unique runs in furniture are dropped by their role. A name inside an article that
only holds a word of furniture ("share-price"), or one of a teaser, leaves it in doubt: such an element stays unless most
of its text is links or boilerplate mostly covers it. One that is a name of furniture altogether ("share-buttons") goes.

Defined results: null and empty pages have an empty text; a null address is a host of its own kind, the empty one;
repeated rows give equal rows, and pages count as distinct by row; an empty table gives an empty one; other columns are
not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import bbit_minhash
from panelspark.llm.common import map_documents
from panelspark.session import materialise

#: Tokens of a run that counts as long.
DEPTH = 8
#: Distinct pages of a host that make a run boilerplate.
SEVERAL = 3
#: Two pages are copies if they share most of their runs: this percentage of those that either has. Minima of a band
#: that finds such pairs: at the limit a pair escapes all 64 bands with probability (1 - 0.51 ** 4) ** 64 = 0.011.
COPY_PERCENT, BAND_ROWS = 51, 4
#: Prefixes that may be broadcast to mark the pages (9 bytes each); more are joined by a shuffle.
BROADCAST_PREFIXES = 2_000_000

MAIN, FURNITURE, OPEN, SKIPPED = 0, 1, 2, 3
#: Roles that only the whole page decides: an article in furniture, one among comments, and (this or more) a form.
ENCLOSED, COMMENT, FORM = 4, 5, 6
#: An element in doubt has a negative role, a number of its own.
#: What an element lies in: nothing of the kind, something hidden, furniture, comments.
FREE, HIDDEN, IN_FURNITURE, IN_COMMENTS = 0, 1, 2, 3

#: Comments and declarations, or a tag whose quoted attribute values may hold a ">".
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)>", re.S
)
#: The same without regard to quotes, for what follows a tag that never ends.
_PLAIN_TAG = re.compile(_TAG.pattern.rpartition("|<(/?)")[0] + r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_TAG_START = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(
    r"(?<![a-zA-Z-])(?:([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))|(hidden)(?![a-zA-Z=-]))"
)
#: Elements whose content is no text of the page, up to their own end tag; script and style go on to it in any case.
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "select"}
_RAW_TAG = {name: re.compile(rf"<(/?){name}(?![^\s/>])[^>]*+(?:>|\Z)", re.I) for name in _RAW}
#: Elements in which a slash ends a tag, and those inside that hold HTML again.
_FOREIGN = {"svg", "math"}
_FOREIGN_HTML = {"foreignobject", "desc", "annotation-xml"}
_ANNOTATIONS = {"annotation", "annotation-xml"}
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Start tags that end a drawing nobody closed, as browsers read them.
_NOT_DRAWN = _BLOCK | set("b big br code em embed i img meta nobr ruby s small span strong strike sub sup tt u var".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE_TAGS = set("head nav header footer aside form menu dialog button object".split())
_FURNITURE_ROLES = set(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split()
)
_COMMENT_NAMES = set("comment comments commentlist disqus respond replies".split())
_FURNITURE_NAMES = _COMMENT_NAMES | set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice popup modal newsletter "
    "subscribe subscription share sharing social related recommended pagination toolbar skip".split()
)
#: Words that, beside one of furniture, leave a name one of furniture: "related-posts", "ad-slot-2".
_PLAIN_NAMES = set(
    "article articles post posts story stories page pages site content news link links list item items button buttons icon "
    "icons box block bar strip container wrapper wrap inner outer row col column widget module section panel slot unit area "
    "group top bottom left right main primary secondary header footer title label text signup form image js the of".split()
)
_TEASER_NAMES = set("teaser teasers card preview".split())
#: Words that make a name with "comments" tell the state of a page, as in "comments-open".
_STATE_NAMES = set("has no with without open opened closed enabled disabled allowed on off".split())
#: All that a head may hold: another tag ends a head that nobody closed.
_HEAD_TAGS = set("html head title base link meta style script noscript template".split())
#: Tags that a form holds if it is wrapped round a page.
_PAGE_TAGS = set("h1 nav header footer section".split())


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(text):
        if m[5]:
            found["hidden"] = ""
        else:
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _names(*values: str) -> set[str]:
    return set(re.split(r"[^a-z0-9]+", " ".join(values).lower()))


def _is_comments(tag: str, attributes: dict[str, str]) -> bool:
    """Whether class or id say comments. An article is one by the singular only: the plural may tell that it has some."""
    if tag in ("html", "body", "main"):
        return False
    wanted = {"comment"} if tag == "article" else _COMMENT_NAMES
    names = map(_names, f"{attributes.get('class', '')} {attributes.get('id', '')}".split())
    return any(words & wanted and not words & _STATE_NAMES for words in names)


def _is_furniture(name: str) -> bool:
    """Whether a class or id is a name of furniture altogether."""
    words = _names(name)
    return bool(words & _FURNITURE_NAMES) and all(w in _FURNITURE_NAMES | _PLAIN_NAMES or not w or w.isdigit() for w in words)


def _role(tag: str, attributes: dict[str, str], outer: int, within: int, forms: int, doubts: int) -> tuple[int, int]:
    """(role, within) of an element inside one of role ``outer``, after so many forms and elements in doubt."""
    if within == HIDDEN:
        return outer, within
    role = attributes.get("role", "").lower()
    hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
    if hidden and tag not in ("html", "body"):
        return FURNITURE, HIDDEN
    if tag == "main" or role == "main":
        return MAIN, FREE
    article = tag == "article" or role == "article" or attributes.get("itemprop", "").lower() == "articlebody"
    if attributes and _is_comments(tag, attributes):
        return COMMENT if article else FURNITURE, IN_COMMENTS
    if tag == "article":
        if within == FREE and _names(attributes.get("class", "")) & _TEASER_NAMES:
            return -1 - doubts, within
        return (MAIN, MAIN, ENCLOSED, COMMENT)[within], within
    in_article = outer < 0 or outer in (MAIN, ENCLOSED, COMMENT)
    if tag == "form":  # holds no role of its own for an article inside
        return FORM + forms if outer == OPEN else FURNITURE, within
    if tag in _FURNITURE_TAGS and not (tag == "header" and in_article) or role in _FURNITURE_ROLES:
        return FURNITURE, max(within, IN_FURNITURE)
    if article:
        return (MAIN, MAIN, ENCLOSED, COMMENT)[within], within
    if attributes and tag not in ("html", "body"):
        given = f"{attributes.get('class', '')} {attributes.get('id', '')}"
        names = _names(given) & _FURNITURE_NAMES - _COMMENT_NAMES
        if names - {"header", "masthead"} if in_article else names:
            if outer <= MAIN and not any(map(_is_furniture, given.split())):
                return (outer if outer < 0 else -1 - doubts), within
            return FURNITURE, within  # a name may be wrong about an article inside
    return outer, within


def _decided(blocks: list[tuple[int, str]], wrapping: set[int]) -> list[tuple[int, str]]:
    """The blocks with the roles that the whole page decides. Beside an article, articles in furniture are teasers and
    those among comments are comments; without one, the former are open, and the latter if they have a title (their
    role is in ``wrapping``) or no other text is."""
    if all(role < ENCLOSED for role, _ in blocks):
        return blocks
    open_roles = set()
    if all(role > MAIN for role, _ in blocks):
        open_roles = {OPEN, ENCLOSED} | wrapping
        if all(role not in open_roles for role, _ in blocks):
            open_roles.add(COMMENT)
    return [(role if role < ENCLOSED else OPEN if role in open_roles else FURNITURE, text) for role, text in blocks]


def _without_link_lists(blocks: list[tuple[int, str]], sizes: Counter[int], linked: Counter[int]) -> list[tuple[int, str]]:
    """Elements in doubt whose text is links for the most part are furniture, if the page has other text of its own."""
    lists = {role for role, n in sizes.items() if 2 * linked[role] > n}
    if lists and any(role <= MAIN and role not in lists for role, _ in blocks):
        return [(FURNITURE if role in lists else role, text) for role, text in blocks]
    return blocks


def _self_closed(attributes: str) -> bool:
    """Whether the slash at the end is the tag's and not that of a value without quotes."""
    return attributes.endswith("/") and not re.search(r"=\s*+[^\s\"']\S*\Z", re.sub(r"\"[^\"]*\"|'[^']*'", '""', attributes))


def _own_ends(page: str, name: str) -> dict[int, int]:
    """Where each element of this raw kind that has an end tag of its own starts, and where it ends."""
    ends, waiting = {}, []
    for m in _RAW_TAG[name].finditer(page):
        if m[1]:
            if waiting:
                ends[waiting.pop()] = m.end()
        elif name in ("script", "style"):
            waiting = waiting or [m.start()]
        else:
            if name != "template":  # the others do not nest
                waiting.clear()
            waiting.append(m.start())
    return ends


def _ends_outer(inside: str, opened: Counter[str], in_paragraph: bool) -> bool:
    """Whether the text between the tags of a raw element ends an element around it."""
    here: Counter[str] = Counter()
    for m in re.finditer(r"<(/?)([a-zA-Z][^\s/>]*+)", inside):
        name = m[2].lower()
        here[name] += -1 if m[1] else 1
        if here[name] < 0 and (opened[name] or name == "p" and in_paragraph):
            return True
    return False


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(role, text) of the blocks of a page in order, with references decoded and white space made one space."""
    blocks: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, int]] = [("", OPEN, FREE)]  # open elements that may matter for a role
    opened: Counter[str] = Counter()  # their names
    foreign: list[str] = []  # those of them that are drawings and formulas, or hold HTML inside one
    own_ends: dict[str, dict[int, int]] = {}
    in_paragraph = False
    forms, wrapping = 0, set()  # the forms so far, and the roles of which something shows that they hold the page
    doubts, in_link = 0, False  # the elements in doubt so far, and whether a link is open
    sizes: Counter[int] = Counter()  # characters in each element in doubt
    linked: Counter[int] = Counter()  # and those of them that are links

    def push(name: str, role: int, within: int) -> None:
        stack.append((name, role, within))
        opened[name] += 1
        if name in _FOREIGN or name in _FOREIGN_HTML:
            foreign.append(name)

    def pop_to(names: set[str]) -> None:
        while len(stack) > 1:
            if stack[-1][1] != SKIPPED and stack[-1][0] != "math":
                flush()
            last = stack.pop()[0]
            opened[last] -= 1
            if last in _FOREIGN or last in _FOREIGN_HTML:
                foreign.pop()
            if last in names:
                break

    def flush() -> None:
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                blocks.append((next(e[1] for e in reversed(stack) if e[1] != SKIPPED), text))
            parts.clear()

    at, tag = 0, _TAG
    while (opening := _TAG_START.search(page, at)) is not None:
        m = tag.match(page, opening.start())
        if m is None and tag is _TAG:
            tag = _PLAIN_TAG
            m = tag.match(page, opening.start())
        if m is None:
            if page.find(">", opening.start()) < 0:
                break
            if stack[-1][1] != SKIPPED:
                parts.append(page[at:opening.end()])
            at = opening.end()
            continue
        if stack[-1][1] != SKIPPED:
            parts.append(page[at:m.start()])
        if stack[-1][1] < 0:
            n = len(page[at:m.start()].strip())
            sizes[stack[-1][1]] += n
            linked[stack[-1][1]] += n if in_link else 0
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name == "a":
            in_link = not closing and "href" in m[3].lower()
        if not closing and foreign:
            while foreign and name in (_NOT_DRAWN if foreign[-1] == "svg" else _BLOCK if foreign[-1] == "math" else ()):
                pop_to(_FOREIGN)
            if foreign and foreign[-1] in _FOREIGN and _self_closed(m[3]):
                continue
        if not closing and opened["head"] and name not in _HEAD_TAGS:
            pop_to({"head"})  # nobody closed it
        if name == "br" and stack[-1][1] != SKIPPED:
            parts.append(" ")
        block = name in _BLOCK
        if block and stack[-1][1] == SKIPPED and not closing and name not in ("option", "hr"):
            if stack[-1][0] == "select" or stack[-1][0] == "option" and opened["select"]:
                pop_to({"select"})  # nobody closed it
            elif stack[-2][0] == "p":
                pop_to({"p"})
        if block and stack[-1][1] != SKIPPED:
            flush()
            in_paragraph = name == "p" and not closing
        if name in _RAW and not closing:
            if name not in own_ends:
                own_ends[name] = _own_ends(page, name)
            end = own_ends[name].get(m.start())
            if name in ("script", "style"):
                at = end or len(page)
            elif end and not (name in ("noscript", "select") and _ends_outer(page[at:end], opened, in_paragraph)):
                at = end
            else:  # without an end tag: up to the end of what is around it
                if in_paragraph and not opened["p"]:
                    push("p", *stack[-1][1:])
                push(name, SKIPPED, HIDDEN)
        elif name in _FOREIGN and not closing:
            if not _self_closed(m[3]):
                push(name, *((SKIPPED, HIDDEN) if name == "svg" else stack[-1][1:]))
        elif foreign and not closing and (name in _FOREIGN_HTML or name in _ANNOTATIONS):
            push(name, *((SKIPPED, HIDDEN) if name in _ANNOTATIONS else stack[-1][1:]))
        elif closing:
            if opened[name]:
                pop_to({name})
        elif name not in _VOID:
            if block and stack[-1][0] == "p":
                opened[stack.pop()[0]] -= 1  # a paragraph ends where another block starts
            attributes = _attributes(m[3]) if m[3] else {}
            outer, within = stack[-1][1:]
            if outer >= FORM and name in _PAGE_TAGS or outer == COMMENT and name == "h1":
                wrapping.add(outer)
            role, within = _role(name, attributes, outer, within, forms, doubts)
            forms += name == "form"
            doubts = max(doubts, -role)
            if block or (role, within) != stack[-1][1:]:
                if not block:
                    flush()
                if name != "p" or (role, within) != stack[-1][1:]:
                    push(name, role, within)
    if stack[-1][1] != SKIPPED:
        parts.append(page[at:])
    flush()
    return _without_link_lists(_decided(blocks, wrapping), sizes, linked)


def host_of(url: str) -> str:
    """The host an address names, in lower case; empty if there is none."""
    found = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", url)
    return found[1].lower() if found else ""


def _outside(blocks: list[tuple[int, str]]) -> list[str]:
    return [t for role, text in blocks if role != MAIN for t in text.split(" ")]


def suffix_prefixes(streams: list[list[str]], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array, to ``depth`` tokens, of concatenated streams: (order, group, stream).

    ``order`` sorts the starts of suffixes that have ``depth`` tokens in their own stream by those tokens; ``group``
    numbers, in that order, suffixes with equal ones; ``stream`` says where each starts. Ranks double in length.
    """
    lengths = np.array([len(s) for s in streams], np.int64)
    numbers: dict[str, int] = {}
    tokens = [numbers.setdefault(t, len(numbers)) for s in streams for t in s]
    owner = np.repeat(np.arange(len(streams)), lengths)
    left = np.repeat(lengths.cumsum(), lengths) - np.arange(len(tokens))  # tokens to the end of the stream
    rank, length = np.array(tokens, np.int64), 1
    while length < depth:
        step = min(length, depth - length)
        ahead = np.zeros(len(rank), np.int64)
        ahead[:len(rank) - step] = rank[step:] + 1
        ahead[left <= step] = 0  # the stream has ended: smaller than any token
        rank = np.unique(rank * (int(ahead.max(initial=0)) + 1) + ahead, return_inverse=True)[1]
        length += step
    whole = np.flatnonzero(left >= depth)
    order = whole[np.argsort(rank[whole], kind="stable")]
    return order, rank[order], owner[order]


def _prefix_key(host: str, tokens: list[str]) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest("\0".join([host, *tokens]))).view(np.int64))


def _page_keys(host: str, stream: list[str], depth: int) -> list[int]:
    return [_prefix_key(host, stream[i:i + depth]) for i in range(len(stream) - depth + 1)]


def shared_prefixes(pages: DataFrame, url: str, page: str, depth: int = DEPTH) -> DataFrame:
    """(prefix, bare): keys of the prefixes of ``depth`` tokens that two or more pages of a host have outside articles,
    and whether one of these pages is undecided: without an article, or with an element in doubt."""

    def make(rows, urls, texts):
        hosts: dict[str, list[tuple[int, bool, list[str]]]] = {}
        for row, u, t in zip(rows, urls, texts):
            blocks = blocks_of(t.decode())
            stream = _outside(blocks)
            if len(stream) >= depth:
                bare = all(role != MAIN for role, _ in blocks) or any(role < 0 for role, _ in blocks)
                hosts.setdefault(host_of(u.decode()), []).append((row, bare, stream))
        for host, found in hosts.items():
            ids, bare = np.array([f[0] for f in found]), np.array([f[1] for f in found])
            streams = [f[2] for f in found]
            order, group, owner = suffix_prefixes(streams, depth)
            starts = np.concatenate(([0], np.array([len(s) for s in streams]).cumsum()))
            cuts = np.flatnonzero(np.diff(group, prepend=-1))
            lo, hi = np.minimum.reduceat(ids[owner], cuts).tolist(), np.maximum.reduceat(ids[owner], cuts).tolist()
            some_bare = np.logical_or.reduceat(bare[owner], cuts).tolist()
            for a, *told in zip(cuts, lo, hi, some_bare):
                who, i = owner[a], order[a] - starts[owner[a]]
                yield 25, (_prefix_key(host, streams[who][i:i + depth]), *told)

    numbered = pages.select(F.monotonically_increasing_id().alias("_row"), F.col(url), F.col(page))
    told = map_documents(numbered, ["_row"], [url, page], make, "prefix bigint, lo bigint, hi bigint, bare boolean")
    return told.groupBy("prefix").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("bare").alias("bare")
    ).filter("lo < hi").select("prefix", "bare")


def _copy_key(host: str, blocks: list[tuple[int, str]], depth: int) -> tuple[int, np.ndarray]:
    """The key of a page's content, equal for equal copies, and its sorted distinct runs."""
    content = [t for role, text in blocks if role in (MAIN, OPEN) for t in text.split(" ")]
    ident = _prefix_key(host, content)
    runs = np.array(_page_keys(host, content, depth) or [ident], np.int64).view(np.uint64)
    return ident, np.unique(bbit_minhash._mixed(runs))


def _copy_bands(least: np.ndarray) -> np.ndarray:
    bands = least.reshape(-1, BAND_ROWS) * bbit_minhash._PLACES[:BAND_ROWS]
    places = np.arange(len(bands), dtype=np.uint64) * bbit_minhash._PLACES[6]
    return bbit_minhash._mixed(bbit_minhash._mixed(bands).sum(axis=1, dtype=np.uint64) + places).view(np.int64)


def with_boilerplate(pages: DataFrame, shared: DataFrame, url: str, page: str, depth: int = DEPTH) -> DataFrame:
    """(prefix, boilerplate): the shared prefixes, and whether SEVERAL pages have them that are no copies of each other.
    Those that no undecided page has are false."""
    wanted = shared.filter("bare").select("prefix")
    if wanted.isEmpty():
        return shared.select("prefix", F.lit(False).alias("boilerplate"))

    def make(urls, texts):
        for u, t in zip(urls, texts):
            host, blocks = host_of(u.decode()), blocks_of(t.decode())
            prefixes = list(set(_page_keys(host, _outside(blocks), depth)))
            if prefixes:
                ident, runs = _copy_key(host, blocks, depth)
                least = bbit_minhash.minima(runs)
                bands, packed = _copy_bands(least).tolist(), bbit_minhash.packed_bits(least).tolist()
                yield 8 * (len(prefixes) + len(runs)) + 600, (ident, prefixes, bands, packed, runs.tobytes())

    fields = "ident bigint, prefixes array<bigint>, bands array<bigint>, packed array<bigint>, runs binary"
    told = materialise(map_documents(pages.select(url, page), [], [url, page], make, fields))
    held = materialise(
        told.select("ident", F.explode("prefixes").alias("prefix")).join(wanted, "prefix").select("prefix", "ident").distinct()
    )
    kept = told.drop("prefixes").join(held.select("ident").distinct(), "ident", "left_semi")
    light = materialise(kept.groupBy("ident").agg(*(F.first(c).alias(c) for c in ("bands", "packed", "runs"))))
    banded = light.select("ident", F.explode("bands").alias("bucket"))
    least = banded.groupBy("bucket").agg(F.min("ident").alias("a"), F.count("*").alias("n")).filter("n > 1")
    pairs = banded.join(least, "bucket").filter("a <> ident").select("a", F.col("ident").alias("b")).distinct()
    packed = light.select("ident", "packed")
    share = COPY_PERCENT / 100 + (1 - COPY_PERCENT / 100) * 0.5 ** bbit_minhash.BITS
    enough = bbit_minhash.HASHES * share - 2 * (bbit_minhash.HASHES * share * (1 - share)) ** 0.5
    near = pairs.join(packed.toDF("a", "pa"), "a").join(packed.toDF("b", "pb"), "b").filter(
        bbit_minhash._matches("pa", "pb") >= enough
    )
    sets = light.select(F.col("ident").alias("cid"), F.col("runs").alias("shingles"))
    copies = bbit_minhash._confirmed(near, sets, COPY_PERCENT)
    labels = bbit_minhash.components(copies).withColumnRenamed("node", "ident")
    distinct = held.join(labels, "ident", "left").groupBy("prefix").agg(
        F.count_distinct(F.coalesce("label", "ident")).alias("n")
    )
    often = distinct.select("prefix", (F.col("n") >= SEVERAL).alias("often"))
    return shared.join(often, "prefix", "left").select("prefix", F.coalesce("often", F.lit(False)).alias("boilerplate"))


def main_text(blocks: list[tuple[int, str]], covered: np.ndarray) -> str:
    """The page's text; ``covered`` says which tokens outside the article lie in boilerplate."""
    article = any(role <= MAIN for role, _ in blocks)
    sizes: Counter[int] = Counter()
    repeated: Counter[int] = Counter()
    unique, at = [], 0
    for role, text in blocks:
        if role == MAIN:
            continue
        n = text.count(" ") + 1
        mine = int(covered[at:at + n].sum())
        if role < 0:  # an element in doubt is judged whole
            sizes[role] += n
            repeated[role] += mine
        elif role == OPEN and 2 * mine < n:
            unique.append(text)
        at += n
    if article:
        kept = [text for role, text in blocks if role == MAIN or role < 0 and 2 * repeated[role] < sizes[role]]
        return "\n".join(kept or [text for role, text in blocks if role < 0])
    return "\n".join(unique or [text for role, text in blocks if role == OPEN])


def _covered(n: int, starts: np.ndarray, depth: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + depth, n), -1)
    return edge.cumsum()[:n] > 0


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", depth: int = DEPTH
) -> DataFrame:
    """(key, url, text, n_outside, n_covered): the text, the tokens outside the article and those of them in runs that
    other pages of the host share. One row for each row of ``pages``."""
    spark = pages.sparkSession
    shared = materialise(shared_prefixes(pages, url, page, depth))
    shared = materialise(with_boilerplate(pages, shared, url, page, depth))
    kind = dict(pages.dtypes)[key]
    if shared.count() <= BROADCAST_PREFIXES:
        rows = sorted((r.prefix, r.boilerplate) for r in shared.collect())
        known = spark.sparkContext.broadcast((np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], bool)))

        def make(keys, addresses, urls, texts):
            for k, address, u, t in zip(keys, addresses, urls, texts):
                prefixes, boilerplate = known.value
                blocks = blocks_of(t.decode())
                stream = _outside(blocks)
                mine = np.array(_page_keys(host_of(u.decode()), stream, depth), np.int64)
                place = np.minimum(np.searchsorted(prefixes, mine), max(0, len(prefixes) - 1))
                starts = np.flatnonzero(prefixes[place] == mine) if len(prefixes) else np.zeros(0, np.int64)
                covered = _covered(len(stream), starts, depth)
                often = starts[boilerplate[place[starts]]]
                text = main_text(blocks, _covered(len(stream), often, depth))
                yield len(text) * 2, (k, address, text, len(stream), int(covered.sum()))

        numbered = pages.select(F.col(key), F.col(url).cast("string").alias("_url"), F.col(url).cast("string").alias("_u"), page)
        told = map_documents(
            numbered, [key, "_url"], ["_u", page], make,
            f"`{key}` {kind}, `{url}` string, text string, n_outside bigint, n_covered bigint",
        )
        return told
    return _extract_joined(pages, shared, key, url, page, depth, kind)


def _extract_joined(pages, shared: DataFrame, key: str, url: str, page: str, depth: int, kind: str) -> DataFrame:
    """As the broadcast form of :func:`extract`, with the shared prefixes joined to the pages' positions."""
    rows = materialise(pages.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), F.col(url).cast("string").alias("_url"),
        F.col(page).alias("_page"),
    ))

    def places(ids, urls, texts):
        for row, u, t in zip(ids, urls, texts):
            for i, p in enumerate(_page_keys(host_of(u.decode()), _outside(blocks_of(t.decode())), depth)):
                yield 24, (row, i, p)

    found = map_documents(rows, ["_row"], ["_url", "_page"], places, "_row bigint, place int, prefix bigint")
    starts = found.join(shared, "prefix").groupBy("_row").agg(
        F.collect_list("place").alias("starts"), F.collect_list(F.when(F.col("boilerplate"), F.col("place"))).alias("often")
    )

    def make(keys, addresses, all_starts, all_often, texts):
        for k, address, starts, often, t in zip(keys, addresses, all_starts, all_often, texts):
            blocks = blocks_of(t.decode())
            n = len(_outside(blocks))
            covered = _covered(n, np.array(starts or [], np.int64), depth)
            text = main_text(blocks, _covered(n, np.array(often or [], np.int64), depth))
            yield len(text) * 2, (k, address, text, n, int(covered.sum()))

    return map_documents(
        rows.join(starts, "_row", "left"), ["_key", "_url", "starts", "often"], ["_page"], make,
        f"`{key}` {kind}, `{url}` string, text string, n_outside bigint, n_covered bigint",
    )
