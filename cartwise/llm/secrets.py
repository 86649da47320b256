"""Secret scans (operator 8): sliding-window entropy per character class.

Three base patterns (assignments, access keys, long hex) are found first.  The
method adds spans: a candidate is a maximal run of a character class (hex digits;
letters, digits and the signs of base64).  A window of fixed width slides over
it, and its Shannon entropy follows from counts updated by the character that
enters and the one that leaves.  Windows at or above the class's threshold are
joined into spans.  Allow-listed candidates are left out: words (letters
only), numbers, unique-id notation, identifiers joined from words, strings marked
as examples, alphabets and digit rows, and candidates that lie inside the host
and path of a link or the domain of a mail address; so are spans that a base span
covers.  A link ends at white space, quotes, brackets, commas, semicolons and
colons, and at its query or fragment: their values and the user part before the
host (``postgres://app:key@db``) are scanned like any text.

Positions are code points, ends exclusive.

Results for odd input: NULL and empty texts have no spans; repeated rows get
equal answers; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame

from .common import id_long, id_text

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ALL_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
WINDOW = 20
THRESHOLD = {"hex": 3.1, "base64": 3.75}
WORDS = [re.compile(p) for p in (r"[A-Za-z]+", r"(?:[A-Za-z]+[_/+=-]+)*[A-Za-z]*[0-9]{0,4}")]
ALLOW = [re.compile(p) for p in (
    r"[0-9]+", r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[0-9]+(?:[-/_][0-9]+)+",
    r"(?s).*(?:example|EXAMPLE|abcdefgh|ABCDEFGH|01234567|12345678).*")]
# a link's host and path after its user part, or a mail address's domain
STOP = r"""\s/?#@"'`,<>(){}\[\]\\|"""
PLACE = r"(?:[\w.-]+|\[[0-9A-Fa-f:.]+\])(?::[0-9]+)?(?:/[\w./~%!$*+@=-]*)?"
LINK = re.compile(rf"(?<=[A-Za-z0-9])://(?P<user>[^{STOP}]*@)?(?P<place>{PLACE})"
                  rf"|(?<![\w@./-])www\.{PLACE}|(?<=[\w.+-])@[\w-]+(?:\.[\w-]+)+")
CASE_BREAK = re.compile(r"[A-Z]{2,}(?=[a-z])|(?<=[A-Z])[a-z](?![a-z])")
CASE_CHANGE = re.compile(r"(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]")
HOOK = re.compile(r"hook", re.IGNORECASE)
WEIGHT = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]  # a window and the next sign


def high_windows(s: str, threshold: float, width: int = WINDOW) -> list[tuple[int, int]]:
    """Joined windows of ``s`` whose entropy reaches ``threshold``; counts change by two characters a step."""
    if len(s) < width:
        return []
    limit = width * (math.log2(width) - threshold)  # entropy >= threshold <=> sum c log c <= limit
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += WEIGHT[c + 1] - WEIGHT[c]
        if i >= width:
            old = s[i - width]
            c = counts[old]
            counts[old] = c - 1
            total += WEIGHT[c - 1] - WEIGHT[c]
        if i >= width - 1 and total <= limit + 1e-9:
            a = i - width + 1
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((a, i + 1))
    return out


def mixed_at_random(s: str) -> bool:
    """Letters whose case changes as no words do: capitals in a row before a small letter, small letters alone."""
    odd = sum(1 for _ in CASE_BREAK.finditer(s))
    return odd * 12 >= len(s) and odd > 2 or odd == 2 and 5 * sum(1 for _ in CASE_CHANGE.finditer(s)) >= 2 * len(s)


def link_places(text: str) -> list[tuple[int, int]]:
    """The hosts and paths of links and the domains of mail addresses, in order; a webhook's path is no such place."""
    return [(m.start("place") if m["user"] else m.start(), m.end()) for m in LINK.finditer(text)
            if not HOOK.search(m.group())]


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text: (kind, start, end), by start, then kind as listed."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    places, more = None, []
    for m in CANDIDATE.finditer(text):
        s = m.group()
        if any(p.fullmatch(s) for p in ALLOW) or any(p.fullmatch(s) for p in WORDS) and not mixed_at_random(s):
            continue
        if places is None:
            places = link_places(text)
        at = bisect_right(places, (m.start(), len(text))) - 1  # the last place that starts here or before
        if at >= 0 and m.end() <= places[at][1]:
            continue
        kind = "hex" if ALL_HEX.fullmatch(s) else "base64"
        more += [(a + m.start(), b + m.start()) for a, b in high_windows(s, THRESHOLD[kind])]
    # spans inside a base span are known: both lists in order of start, and how far base spans reach so far
    reach, k = -1, 0
    base = sorted((x, y) for _, x, y in found)
    for a, b in more:
        while k < len(base) and base[k][0] <= a:
            reach, k = max(reach, base[k][1]), k + 1
        if b > reach:
            found.append(("entropy", a, b))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def written_spans(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def secret_scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy."""
    def rows(batches):
        for pdf in batches:
            out = []
            for d, t in zip(pdf["doc_id"], pdf["text"]):
                spans = scan(t) if t else []
                base = [s for s in spans if s[0] != "entropy"]
                n = {k: sum(s[0] == k for s in spans) for k in KINDS}
                out.append((d, n["assign"], n["access"], n["hex"],
                            hashlib.sha256(written_spans(base).encode()).hexdigest(), written_spans(spans), n["entropy"]))
            yield pd.DataFrame(out, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans",
                                             "n_entropy"])

    return id_long(id_text(docs.select("doc_id", "text")).mapInPandas(
        rows, "doc_id string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"))
