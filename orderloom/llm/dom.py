"""Pages as trees of blocks, and the features of their nodes.

Nodes are block elements and, as leaves, segments: runs of text that no block boundary cuts. Inline elements are no
nodes; they count as links, tags and attribute words of the segment they are in.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

# a comment also ends at its own start (<!-->, <!--->) and at --!>
TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>?",
                   re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Fixed by the HTML standard: elements without content, elements whose content is no markup, inline elements, and
# elements that a new one of the same kind closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe template svg xmp noembed noframes".split())
# of these, the ones that end at once where they are never closed; the others take the rest of the page
ENDS_AT_ONCE = frozenset("iframe template svg xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark object q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot msub "
                   "msup msubsup munder mover munderover mstyle mpadded mphantom semantics annotation".split())
MOST_ALIKE = 3  # of inline elements alike that are open at once, as many as the HTML standard opens anew
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr main menu nav ol pre section table ul".split())
WALLS = frozenset("table ul ol dl body html article section div form nav aside header footer main".split())

KINDS = {
    "paragraph": "p pre blockquote", "heading": "h1 h2 h3 h4 h5 h6", "list": "ul ol dl menu", "item": "li dt dd",
    "division": "div section", "article": "article", "main": "main", "nav": "nav", "header": "header",
    "footer": "footer", "aside": "aside", "form": "form fieldset button select option label input legend",
    "table": "table tbody thead tr td th", "segment": "#text", "top": "html body", "figure": "figure figcaption",
}
KIND_OF = {tag: i for i, tags in enumerate(KINDS.values()) for tag in tags.split()}
# words in class, id and role that pages use for their parts
GROUPS = {
    "content": "content article post entry story body text main blog news prose page",
    "nav": "nav navigation menu navbar breadcrumb breadcrumbs topbar toolbar pager pagination tabs skip toc",
    "header": "header masthead logo brand site top",
    "footer": "footer copyright legal bottom colophon",
    "side": "sidebar side aside widget related recommended more popular trending rail teaser promo",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored banner dfp outbrain taboola",
    "comment": "comment comments reply replies discussion disqus respond commentlist feedback review reviews",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog warning message toast privacy",
    "share": "share sharing social follow facebook twitter tags tag meta byline author",
    "form": "form search login signup subscribe subscription newsletter email register contact",
}
GROUP_OF = {word: i for i, words in enumerate(GROUPS.values()) for word in words.split()}
SENTENCE_END = re.compile(r"[.!?](?:\s|$)")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    groups: list[int]
    text: str = ""
    link_chars: int = 0
    inline_tags: int = 0
    children: list[int] = field(default_factory=list)


def _groups(attributes: str) -> list[int]:
    found = []
    if "=" in attributes:
        for value in ATTRIBUTE.findall(attributes):
            found += [GROUP_OF[w] for w in map(str.lower, WORD.findall(value)) if w in GROUP_OF]
    return found


def parse(page: str) -> list[Node]:
    """The nodes of a page in page order, the root first. Any text gives a tree; nothing of it is lost but comments,
    declarations, tags and the content of RAW elements."""
    nodes = [Node("#root", -1, 0, [])]
    open_blocks = [0]
    inline: list[tuple[str, list[int]]] = []
    run: list[str] = []
    links = [0, 0]  # characters in links, inline tags
    own: list[int] = []
    began = [False]  # whether the segment has text
    open_links = [0]
    alike: Counter = Counter()

    def open_inline(name: str, groups: list[int]) -> None:
        links[1] += 1
        kind = (name, tuple(groups))
        if alike[kind] < MOST_ALIKE:
            alike[kind] += 1
            inline.append((name, groups))
            open_links[0] += name == "a"
            if began[0]:
                own.extend(groups)

    def close_inline(name: str) -> None:
        for i in range(len(inline) - 1, -1, -1):
            if inline[i][0] == name:
                alike[(name, tuple(inline[i][1]))] -= 1
                open_links[0] -= name == "a"
                del inline[i]
                break

    def clear_inline() -> None:
        inline.clear()
        alike.clear()
        open_links[0] = 0

    def end_segment() -> None:
        text = " ".join(unescape("".join(run)).split())
        if text:
            at = open_blocks[-1]
            nodes[at].children.append(len(nodes))
            nodes.append(Node("#text", at, nodes[at].depth + 1, own[:], text, min(links[0], len(text)), links[1]))
        run.clear()
        own.clear()
        links[:] = [0, 0]
        began[0] = False

    def add_text(text: str) -> None:
        run.append(text)
        if text.strip():
            if not began[0]:  # a segment has the words of each inline element it lies in once
                began[0] = True
                for _, groups in inline:
                    own.extend(groups)
            if open_links[0]:
                links[0] += len(text)

    def close_to(index: int) -> None:
        end_segment()
        del open_blocks[index:]

    at = 0
    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            add_text(page[at:])
            break
        if found.start() > at:
            add_text(page[at:found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW:
            if not found[1] and not found[3].endswith("/"):
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag not in ENDS_AT_ONCE:
                    at = len(page)
            if tag == "svg":
                run.append(" ")
        elif tag == "br":
            run.append(" ")
        elif tag in INLINE:
            if found[1]:
                close_inline(tag)
            elif not found[3].endswith("/") or tag == "a":
                open_inline(tag, _groups(found[3]))
        elif found[1]:
            end_segment()
            for i in range(len(open_blocks) - 1, 0, -1):
                name = nodes[open_blocks[i]].tag
                if name == tag:
                    close_to(i)
                    clear_inline()
                    break
                if name in WALLS and tag in ("p", "li", "td", "th", "tr", "dd", "dt"):
                    break
        elif tag in ("img", "input", "wbr", "meta", "link", "source", "col", "param", "track", "area", "base", "embed"):
            if tag == "input":
                end_segment()
        else:
            end_segment()
            closes = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
            for i in range(len(open_blocks) - 1, 0, -1):
                name = nodes[open_blocks[i]].tag
                if name in closes:
                    close_to(i)
                    clear_inline()
                    break
                if name in WALLS:
                    break
            if tag in VOID:
                continue
            parent = open_blocks[-1]
            nodes[parent].children.append(len(nodes))
            groups = _groups(found[3])
            for _, more in inline:
                groups += more
            open_blocks.append(len(nodes))
            nodes.append(Node(tag, parent, nodes[parent].depth + 1, groups))
    end_segment()
    return nodes


FEATURE_NAMES = [*(f"is_{k}" for k in KINDS), *(f"in_{k}" for k in KINDS), *(f"own_{g}" for g in GROUPS),
                 *(f"above_{g}" for g in GROUPS), "level", "characters", "words", "link_density", "tags_per_text",
                 "sentence_ends", "commas", "mean_word", "paragraphs", "blocks", "segments", "children", "sibling_at",
                 "siblings", "like_siblings", "share_of_parent", "share_of_page", "before", "previous", "next",
                 "digits", "other_signs"]


def features(nodes: list[Node]) -> list[list[float]]:
    """One row of FEATURE_NAMES per node: kind, kinds and attribute words above it, density and counts of its
    subtree, depth, and how it compares with its siblings."""
    n, kinds, groups = len(nodes), len(KINDS), len(GROUPS)
    chars, words, linked, tags, ends, commas, paragraphs, blocks, segments, digits, signs = ([0] * n for _ in range(11))
    for i, node in enumerate(nodes):
        if node.text:
            text = node.text
            chars[i], words[i], linked[i], tags[i] = len(text), text.count(" ") + 1, node.link_chars, node.inline_tags
            ends[i], commas[i], segments[i] = len(SENTENCE_END.findall(text)), text.count(","), 1
            digits[i] = sum(map(str.isdigit, text))
            signs[i] = sum(text.count(c) for c in "©|·»›•")
        else:
            blocks[i], paragraphs[i], tags[i] = 1, node.tag == "p", 1
    before, seen = [0] * n, 0
    for i in range(n):
        before[i] = seen
        seen += chars[i]
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        for values in (chars, words, linked, tags, ends, commas, paragraphs, blocks, segments, digits, signs):
            values[p] += values[i]
    place, alike = [0] * n, [1] * n  # place in the family, and how many of it have the same tag
    for node in nodes:
        tally = Counter(nodes[c].tag for c in node.children)
        for k, c in enumerate(node.children):
            place[c], alike[c] = k, tally[nodes[c].tag]
    above_kind, above_group = [[0] * kinds for _ in range(n)], [[0] * groups for _ in range(n)]
    out = []
    total = max(chars[0], 1)
    for i, node in enumerate(nodes):
        p = max(node.parent, 0)
        kind = KIND_OF.get(node.tag, -1)
        own = [0] * groups
        for g in node.groups:
            own[g] = 1
        if i:
            above_kind[i] = above_kind[p][:]
            above_group[i] = above_group[p][:]
            parent_kind = KIND_OF.get(nodes[p].tag, -1)
            if parent_kind >= 0:
                above_kind[i][parent_kind] = 1
            for g in nodes[p].groups:
                above_group[i][g] = 1
        family = nodes[p].children if i else [0]
        at = place[i]
        previous = chars[family[at - 1]] if at else 0
        following = chars[family[at + 1]] if at + 1 < len(family) else 0
        row = [0] * kinds
        if kind >= 0:
            row[kind] = 1
        w = max(words[i], 1)
        out.append(row + above_kind[i] + own + above_group[i] + [
            node.depth, math.log1p(chars[i]), math.log1p(words[i]), linked[i] / max(chars[i], 1), tags[i] / w,
            ends[i] / w, commas[i] / w, chars[i] / w, math.log1p(paragraphs[i]), math.log1p(blocks[i]),
            math.log1p(segments[i]), math.log1p(len(node.children)), at / max(len(family), 1),
            math.log1p(len(family)), alike[i] / max(len(family), 1), chars[i] / max(chars[p], 1), chars[i] / total,
            before[i] / total, math.log1p(previous), math.log1p(following), digits[i] / max(chars[i], 1),
            signs[i] / w])
    return out
