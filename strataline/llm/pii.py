"""Personal data by a semi-Markov conditional random field over candidate segments.

Fixed patterns give the base spans, which always stay. Around every digit, `@` and spelled-out
"at" a region of tokens is cut out, and a semi-Markov model scores whole candidate segments of
it by features of the span; dynamic programming over segments of bounded length chooses
boundaries and kinds together. The model is trained here on base spans of the corpus and on
rewritten forms of them that the patterns do not know (phone numbers without a plus sign,
cards with dots, spelled-out mail addresses).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.caches import in_worker
from strataline.llm.storage import bounded_batches, sampled

KINDS = ("email", "ip", "card", "phone")
#: Tokens in an entity at most.
MAX_TOKENS = 24
#: The model is trained on about so many rows, drawn by hash, of which texts with a digit or `@` of
#: at most so many characters are taken; and on so many regions of them.
TRAINING_ROWS = 5000
TRAINING_CHARS = 8_000
TRAINING_REGIONS = 1500
EPOCHS = 4
RATE, DECAY = 0.3, 1e-4
#: A predicted segment is added if its log odds against the best reading without it reach this.
MARGIN = 1.0

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Whole runs of digits only: a match always ends with one, so none starts inside one.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    try:
        return len(part) <= 3 and (not part or int(part) <= 255)
    except ValueError:  # a candidate segment may hold other signs, as in 10.0.0.7-1
        return False


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns: leftmost, not overlapping within a kind, by kind and start.

    A match that fails its further condition is dropped and the search goes on after it.
    """
    found: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


#: A number without a plus sign: a dialling code, then groups; so neither a date nor a plain number.
_NATIONAL = re.compile(r"(?:\([0-9]{2,5}\)|[0-9]{1,3}[ .-]\(?[0-9]{2,4}\)?|[0-9]{2,4})[ .-][0-9]{3}")
_TRIGGER = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]", re.ASCII)
_REST = re.compile(r"\S*")
_NEXT = re.compile(r" {1,2}(?=\S{0,40}[0-9@]|[\[(](?:at|dot)[\])])")
_SPELLED = re.compile(r"[\[(](?:at|dot)[\])]")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|[\[(](?:at|dot)[\])]|.", re.DOTALL)


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of neighbouring chunks that each hold a digit, an `@` or a spelled-out sign.

    A chunk next to a spelled-out sign belongs to it too. Chunks are whole runs without white
    space, however long. Regions do not overlap.
    """
    done, m = 0, _TRIGGER.search(text)
    while m:
        low = done
        start = 1 + max(low - 1, *(text.rfind(c, low, m.start()) for c in " \n\t"))
        if m[0][0] in "[(" and start == m.start() and start > low:  # the chunk before it
            before = start - 1
            start = 1 + max(low - 1, *(text.rfind(c, low, before) for c in " \n\t"))
        end = _REST.match(text, m.start()).end()
        while True:
            spelled = _SPELLED.search(text, max(start, end - 6), end)
            if spelled and spelled.end() == end and text[end : end + 1] == " ":
                grown = _REST.match(text, end + 1).end()
            elif gap := _NEXT.match(text, end):
                grown = _REST.match(text, gap.end()).end()
            else:
                break
            if grown <= end:
                break
            end = grown
        yield start, end
        done = end
        m = _TRIGGER.search(text, end)


def tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, start, end)]


def _ends_segments(piece: str) -> bool:
    """Whether no candidate segment may hold this token (see `candidates`)."""
    head = piece[0]
    if "\n" in piece or len(piece) > 64:
        return True
    return not ("0" <= head <= "9" or (len(piece) > 1 and head in "[(") or head in "@. -+()%_" or head.isalpha())


def sections(text: str, start: int, end: int) -> Iterator[list[tuple[int, int]]]:
    """The tokens of a region, parted at tokens that no segment may hold: readings of the parts
    are those of the whole, and a long run is not held in memory at once."""
    cut: list[tuple[int, int]] = []
    for m in _TOKEN.finditer(text, start, end):
        if not _ends_segments(m[0]):
            cut.append(m.span())
        elif cut:
            yield cut
            cut = []
    if cut:
        yield cut


def _shape(text: str) -> str:
    """The span with each run of digits as its length, of letters as `a`."""
    out = re.sub(r"[0-9]+", lambda m: str(min(9, len(m[0]))), re.sub(r"[^\W\d_]+", "a", text))
    return out[:40]


def candidates(text: str, cut: list[tuple[int, int]]) -> dict[int, list[tuple[int, str, list[str]]]]:
    """For each end position in tokens: (start, kind, features) of the segments that may be entities.

    Segments start and end at a token that is no white space; a kind has hard limits on what a
    segment may hold, so few segments remain.
    """
    found: dict[int, list[tuple[int, str, list[str]]]] = defaultdict(list)
    for i, (a, _) in enumerate(cut):
        first = text[a]
        if first.isspace():
            continue
        letters = digits = signs = dots = tail = 0
        for j in range(i, min(len(cut), i + MAX_TOKENS)):
            x, y = cut[j]
            piece = text[x:y]
            if "\n" in piece or len(piece) > 64:
                break
            head = piece[0]
            if "0" <= head <= "9":
                digits += len(piece)
            elif len(piece) > 1 and head in "[(":
                signs += piece[1:-1] == "at"
                dots += piece[1:-1] == "dot"
                tail += signs == 1 and piece[1:-1] == "dot"
            elif head == "@":
                signs += 1
            elif head == ".":
                dots += 1
                tail += signs == 1
            elif head.isalpha():
                letters += 1
            elif head not in " -+()%_":
                break
            if signs > 1 or digits > 40:
                break
            last = text[y - 1]
            if last.isspace():
                continue
            if signs == 1 and tail and (letters or digits) and last.isalnum() and (first.isalnum() or first in "._%+-"):
                found[j].append((i, "email", _features("email", text, a, y, digits)))
            if letters or signs:
                continue
            if dots == 3 and 4 <= digits <= 12 and first.isdigit() and all(map(_small, text[a:y].split("."))):
                found[j].append((i, "ip", _features("ip", text, a, y, digits)))
            if 13 <= digits <= 19 and first.isdigit() and last.isdigit():
                found[j].append((i, "card", _features("card", text, a, y, digits)))
            if 9 <= digits <= 15 and last.isdigit() and (first == "+" or _NATIONAL.match(text, a, y)):
                found[j].append((i, "phone", _features("phone", text, a, y, digits)))
    return found


def _features(kind: str, text: str, a: int, b: int, digits: int) -> list[str]:
    """What the model sees of a whole segment."""
    span = text[a:b]
    before, after = text[a - 1 : a], text[b : b + 1]
    marks = "".join(sorted({c for c in span if not c.isalnum()}))
    out = [
        kind,
        f"{kind} shape {_shape(span)}",
        f"{kind} digits {digits}",
        f"{kind} marks {marks}",
        f"{kind} joined before {before.isalnum() or before in tuple('-+./=_@')}",
        f"{kind} joined after {after.isalnum() or (after in tuple('-/=_@'))}",
        f"{kind} starts {'+' if span[0] == '+' else '(' if span[0] == '(' else 'a' if span[0].isalpha() else '9'}",
    ]
    if kind == "card":
        out.append(f"card check {luhn(_digits(span))}")
    elif kind == "ip":
        out.append(f"ip parts {all(map(_small, span.split('.')))}")
    elif kind == "email":
        out.append(f"email spaced {' ' in span} {'[' in span or '(' in span}")
        out.append(f"email double {'..' in span or '.@' in span}")
    return out


class SemiMarkov:
    """Weights of span features. A token outside any entity scores 0."""

    def __init__(self, weights: dict[str, float] | None = None) -> None:
        self.weights = weights or {}

    def score(self, features: list[str]) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features)

    def decode(self, text: str, cut: list[tuple[int, int]], found: dict) -> list[Span]:
        """The best reading of a region: non-overlapping segments, boundaries and kinds at once."""
        best, back = [0.0], [None]
        for j in range(len(cut)):
            top, how = best[j], None
            for i, kind, features in found.get(j, ()):
                value = best[i] + self.score(features) - MARGIN
                if value > top:
                    top, how = value, (i, kind)
            best.append(top)
            back.append(how)
        spans, j = [], len(cut)
        while j:
            if back[j] is None:
                j -= 1
                continue
            i, kind = back[j]
            spans.append((kind, cut[i][0], cut[j - 1][1]))
            j = i
        return spans[::-1]

    def fit(self, examples: list[tuple[str, list[tuple[int, int]], dict, set[Span]]]) -> SemiMarkov:
        """Adaptive gradient steps on the log-likelihood of each region's true segments."""
        seen: dict[str, float] = defaultdict(float)
        for _ in range(EPOCHS):
            for text, cut, found, gold in examples:
                gradient = self._gradient(text, cut, found, gold)
                for name, g in gradient.items():
                    g -= DECAY * self.weights.get(name, 0.0)
                    seen[name] += g * g
                    self.weights[name] = self.weights.get(name, 0.0) + RATE * g / (1e-6 + seen[name] ** 0.5)
        return self

    def _gradient(self, text: str, cut: list, found: dict, gold: set[Span]) -> dict[str, float]:
        """Features of the true segments less their expectation, by forward and backward sums."""
        n = len(cut)
        scored = [(i, j, kind, f, self.score(f)) for j, some in found.items() for i, kind, f in some]
        ending, starting = defaultdict(list), defaultdict(list)
        for s in scored:
            ending[s[1]].append(s)
            starting[s[0]].append(s)
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(n):
            ahead[j + 1] = _log_sum([ahead[j], *(ahead[s[0]] + s[4] for s in ending[j])])
        for i in range(n - 1, -1, -1):
            behind[i] = _log_sum([behind[i + 1], *(behind[s[1] + 1] + s[4] for s in starting[i])])
        out: dict[str, float] = defaultdict(float)
        for i, j, kind, features, value in scored:
            p = exp(min(0.0, ahead[i] + value + behind[j + 1] - ahead[n]))
            g = ((kind, cut[i][0], cut[j][1]) in gold) - p
            if abs(g) > 1e-4:
                for f in features:
                    out[f] += g
        return out


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + log(sum(exp(v - top) for v in values))


def _variants(text: str, base: list[Span]) -> list[tuple[str, list[Span]]]:
    """The text around each base span, as it is and with the span in another form."""
    out = []
    for kind, a, b in base:
        span = text[a:b]
        low, high = max(0, a - 60), min(len(text), b + 60)
        forms = [span]
        if kind == "phone":
            plain = span.lstrip("+")
            forms += [plain, re.sub(r"^[0-9]{1,3}[ .-]+", "", plain), re.sub(r"[ ().-]+", "-", plain)]
        elif kind == "card":
            digits = _digits(span)
            forms.append(".".join(digits[k : k + 4] for k in range(0, len(digits), 4)))
        elif kind == "email":
            forms += [span.replace("@", " [at] ").replace(".", " [dot] "), span.replace("@", "(at)")]
        for form in dict.fromkeys(forms):
            if sum(c.isdigit() for c in form) < 7 and kind == "phone":
                continue
            inside = [(k, x - low, y - low) for k, x, y in base if low <= x and y <= high and (y <= a or x >= b)]
            moved = len(form) - len(span)
            inside = [(k, x + moved * (x >= b - low), y + moved * (x >= b - low)) for k, x, y in inside]
            out.append((text[low:a] + form + text[b:high], [*inside, (kind, a - low, a - low + len(form))]))
    return out


def train(texts: list[str]) -> SemiMarkov:
    """A model from base spans, their rewritten forms, and regions without any."""
    examples = []
    for text in texts:
        base = base_spans(text)
        spread = _variants(text, base)
        taken = [(a, b) for _, a, b in base]
        for a, b in regions(text):
            if not any(x < b and a < y for x, y in taken):
                spread.append((text[max(0, a - 20) : b + 20], []))
        for piece, gold in spread:
            for a, b in regions(piece):
                cut = tokens(piece, a, b)
                if found := candidates(piece, cut):
                    examples.append((piece, cut, found, set(gold)))
        if len(examples) >= TRAINING_REGIONS:
            break
    return SemiMarkov().fit(examples[:TRAINING_REGIONS])


def all_spans(text: str, base: list[Span], model: SemiMarkov) -> list[Span]:
    """Base spans and the model's further ones, which touch none of them; by kind and start."""
    found = list(base)
    taken = sorted((a, b) for _, a, b in base)
    for cut in (cut for a, b in regions(text) for cut in sections(text, a, b)):
        if some := candidates(text, cut):
            found += [s for s in model.decode(text, cut, some) if not any(x < s[2] and s[1] < y for x, y in taken)]
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def trained_model(documents: DataFrame) -> SemiMarkov:
    """Fit the model on a bounded sample; without a text to learn from it predicts nothing."""
    text = F.col("text").cast("string")
    some = sampled(documents.select("doc_id", text.alias("text")), TRAINING_ROWS, "doc_id", "text")
    some = some.where(F.length("text").between(1, TRAINING_CHARS) & F.col("text").rlike("[0-9@]"))
    return train(sorted({r[0] for r in some.select("text").collect()}))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def find_personal_data(documents: DataFrame, model: SemiMarkov | None = None) -> DataFrame:
    """All columns of `documents` that are named below, and their personal data.

    (doc_id, text, base, spans, redacted): `base` and `spans` as kind:start:end joined by commas,
    in code points with exclusive ends. Takes `doc_id` and `text`; a null text has no spans and
    stays null when redacted. Repeated rows are treated alike; an empty table gives an empty
    result. Nothing is shuffled but the bounded training sample.
    """
    bounded_batches(documents.sparkSession)
    weights = (model or trained_model(documents)).weights
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("base", pa.string()), ("spans", pa.string()), ("redacted", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SemiMarkov(weights)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                base = base_spans(text or "")
                spans = all_spans(text or "", base, own)
                rows.append((doc_id, text, joined(base), joined(spans), text if not spans else redacted(text, spans)))
            columns = zip(*rows, strict=True)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    kind = "doc_id long, text string, base string, spans string, redacted string"
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(in_worker(search), kind)




def redact(documents: DataFrame, model: SemiMarkov | None = None) -> DataFrame:
    """`documents` with every span of personal data in `text` replaced by its kind in brackets.

    All columns stay; `n_chars`, if there is one, is counted anew. A null text stays null, an empty
    one empty, repeated rows are replaced alike; an empty table stays empty.
    """
    bounded_batches(documents.sparkSession)
    weights = (model or trained_model(documents)).weights
    at = documents.columns.index("text")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SemiMarkov(weights)
        for batch in batches:
            texts = []
            for value in batch[at].to_pylist():
                spans = all_spans(value, base_spans(value), own) if value else []
                texts.append(redacted(value, spans) if spans else value)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = documents.mapInArrow(in_worker(search), documents.schema)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out
