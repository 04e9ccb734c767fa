"""Personal data: base patterns, and spans that a character-level BiLSTM-CRF adds to them.

The patterns find the plain forms of four kinds, exactly as they are defined. The network learns
from labelled spans in a bounded sample of documents: those of the patterns, as they are and
rewritten into forms that the patterns miss (``name at host``, a phone number without its
country, a card number with dots), invented data of these forms put between words of the sampled
texts, and look-alikes that are none, such as dates and versions.
Every text is read as a whole, in overlapping windows that begin anew in every text, so what is found
in a text never depends on other texts. As a span must be of a form of its kind, every text is first
searched for what all those forms contain, and windows far from any such place, where no span could
be kept, are not decoded. Each window is decoded by itself; a span
counts where its middle lies in the core of the window, and what two windows see of one span is
united. An added span is fitted to the words it lies in, and dropped when it touches a base span
or lacks what its kind must have, such as enough digits.

Null texts are empty and have no spans. Rows without a ``doc_id`` are read like others, repeated
rows each get a row. Very long texts cost time in proportion to their length, windows at a time.
Where no sampled text has a word to put data beside, the patterns stand alone. An empty table gives
no rows; further columns are ignored, or passed on by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.llm.tables import drawn
from panewise.llm.tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

#: The learning sample: documents with and without digits or signs of addresses, and their length.
MARKED_ROWS = 500
PLAIN_ROWS = 100
LEARNED_CHARS = 20_000
STEPS = 64  # characters of a learning window
FOUND_WINDOWS = 800  # learning windows around what the sample holds
INVENTED = 1_400  # learning windows around invented data
LOOKALIKES = 500  # and around invented look-alikes
BATCH = 128  # learning windows of a step
BATCHES = 640

WINDOW = 512
OVERLAP = 64
WIDTH = 128  # the last window of a text is as wide as the text needs, in steps of this
STREAM = 1 << 19  # characters that are read at once
REACH = 128  # beyond a window: where its spans may be fitted to, and spans that touch them

# Where a run of possible first characters fails, all later starts in it fail too, so only its
# beginning is tried. A run that an earlier match cut into is tried from the end of that match.
_EMAIL_REST = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL_REST)
EMAIL_HERE = re.compile(_EMAIL_REST)
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))
    digits = _digits(text)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def _emails(text: str) -> Iterator[re.Match[str]]:
    """Leftmost non-overlapping addresses, in time linear in the text."""
    at = 0
    while found := EMAIL_HERE.match(text, at) or EMAIL.search(text, at):
        yield found
        at = found.end()


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind and start; matches that fail their check are dropped."""
    found = []
    has_digit = DIGIT.search(text) is not None
    for kind, matches, possible in (
        ("email", _emails, "@" in text),
        ("ip", IP.finditer, has_digit and "." in text),
        ("card", CARD.finditer, has_digit),
        ("phone", PHONE.finditer, has_digit and "+" in text),
    ):
        if possible:
            found += [(kind, m.start(), m.end()) for m in matches(text) if _valid(kind, m[0])]
    return found


_SIGNS = "\n @.-+()_%:/,=\"#!'[]"
_CLASSES = 6 + len(_SIGNS)
_CLASS = np.full(0x250, 5, dtype=np.int8)  # other signs
for _c in range(0x250):
    _ch = chr(_c)
    if _ch.isalpha():
        _CLASS[_c] = 3 if _c >= 128 else 2 if _ch.isupper() else 1
    elif "0" <= _ch <= "9":
        _CLASS[_c] = 4
for _k, _ch in enumerate(_SIGNS):
    _CLASS[ord(_ch)] = 6 + _k


def symbols(text: str) -> np.ndarray:
    """The class of each character; 0 is kept for what lies outside of texts."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(points < 0x250, _CLASS[np.minimum(points, 0x24F)], 3).astype(np.int8)


def _pick(rng: np.random.Generator, *of: str) -> str:
    return of[int(rng.integers(len(of)))]


def _rewritten(kind: str, text: str, rng: np.random.Generator) -> str:
    """Another form of the same datum."""
    if kind == "email":
        text = text.replace("@", _pick(rng, " at ", " (at) ", "[at]", " [at] ", "(at)", " @ "))
        return text.replace(".", _pick(rng, ".", ".", " dot ", "[.]"))
    digits = _digits(text)
    if kind == "card":
        return _pick(rng, ".", "-", " ", "/", "").join(digits[k : k + 4] for k in range(0, len(digits), 4))
    if kind == "ip":
        return text.replace(".", _pick(rng, "[.]", "(.)", " . "))
    area, head, tail = digits[-10:-7], digits[-7:-4], digits[-4:]
    return _pick(
        rng,
        f"({area}) {head}-{tail}",
        f"{area}-{head}-{tail}",
        f"{area}.{head}.{tail}",
        f"{area} {head} {tail}",
        f"00{digits[:-10] or 1} {area} {head} {tail}",
    )


def invented(kind: str, rng: np.random.Generator) -> str:
    """A made-up datum in a plain form, which the patterns find."""
    letters = lambda low, high: "".join(map(chr, rng.integers(97, 123, int(rng.integers(low, high + 1)))))
    number = lambda count: "".join(map(str, rng.integers(0, 10, count)))
    if kind == "email":
        name = letters(3, 8) + _pick(rng, "", "." + letters(3, 8), "_" + letters(2, 6), str(rng.integers(1, 999)))
        return f"{name}@{letters(3, 9)}{_pick(rng, '', '', '-' + letters(2, 5), '.' + letters(3, 6))}.{_pick(rng, 'com', 'org', 'net', 'de', 'io')}"
    if kind == "ip":
        return ".".join(map(str, rng.integers(0, 256, 4)))
    if kind == "card":
        head = _pick(rng, "4", "5", "6") + number(14)
        return next(head + last for last in "0123456789" if luhn(head + last))
    return f"+{_pick(rng, '1', '44', '49', '33', '34')} {rng.integers(200, 999)} {rng.integers(200, 999)} {number(4)}"


def lookalike(rng: np.random.Generator) -> str:
    """Something with digits or signs that is no personal data."""
    n = lambda low, high: int(rng.integers(low, high))
    return _pick(
        rng,
        f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}",
        f"{n(1, 29):02}.{n(1, 13):02}.{n(1900, 2100)}",
        f"{n(1, 13)}/{n(1, 29)}/{n(1900, 2100)}",
        f"{n(0, 24):02}:{n(0, 60):02}:{n(0, 60):02}",
        f"{n(1900, 2000)}-{n(2000, 2100)}",
        f"{n(0, 30)}.{n(0, 20)}.{n(0, 20)}",
        f"{n(1, 999)},{n(0, 999):03},{n(0, 999):03}",
        f"{n(1, 999)}.{n(0, 999):03}.{n(0, 999):03}",
        f"{n(0, 9999)}.{n(0, 99):02}",
        f"no. {n(10_000, 10**12)}",
        f"({n(1, 400)})",
        f"at {n(1, 13)} {_pick(rng, 'am', 'pm')}",
        f"{n(1, 99)}-{n(100, 999)}",
    )


def learning_windows(texts: list[str], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(step, row) of classes and labels: windows around spans, look-alikes and plain text."""
    rng = np.random.default_rng(seed)
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    gaps: list[tuple[int, int]] = []  # (text, place of a space) far from any span

    def window(before: str, middle: str, after: str, label: int) -> None:
        lead = int(rng.integers(0, max(1, STEPS - min(len(middle), STEPS - 1))))
        before = before[-lead:] if lead else ""
        classes = np.zeros(STEPS, dtype=np.int8)
        labels = np.zeros(STEPS, dtype=np.int64)
        line = symbols(before + middle + after[:STEPS])[:STEPS]
        classes[: len(line)] = line
        labels[len(before) : min(len(before) + len(middle), STEPS)] = label
        rows.append((classes, labels))

    for number in rng.permutation(len(texts)).tolist():
        text = texts[number]
        spans = base_spans(text)
        taken = np.zeros(len(text) + 1, dtype=bool)
        for kind, start, end in spans:
            taken[start:end] = True
        for kind, start, end in spans if len(rows) < FOUND_WINDOWS else ():
            near = taken[max(0, start - STEPS) : start].any() or taken[end : end + STEPS].any()
            if not near and end - start < STEPS:
                for turn in range(4):
                    middle = text[start:end] if turn < 2 else _rewritten(kind, text[start:end], rng)
                    window(text[max(0, start - STEPS) : start], middle, text[end : end + STEPS], 1 + KINDS.index(kind))
        free = lambda at: not taken[max(0, at - STEPS) : at + STEPS].any()
        signs = [m.start() for m in re.finditer(r"[0-9]+|@| at ", text) if free(m.start())]
        signs = signs[:: max(1, len(signs) // 4)][:4]
        for at in [*signs, *rng.integers(0, max(1, len(text)), 2).tolist()] if len(rows) < FOUND_WINDOWS else ():
            if free(at):
                window(text[max(0, at - STEPS) : at], text[at : at + 1], text[at + 1 : at + STEPS], 0)
        spaces = [m.start() for m in re.finditer(r"(?<=\w) (?=\w)", text)]
        gaps += [(number, at) for at in spaces[:: max(1, len(spaces) // 20)] if free(at)]
    for turn in range(INVENTED + LOOKALIKES if gaps else 0):
        number, at = gaps[int(rng.integers(len(gaps)))]
        before, after = texts[number][max(0, at - STEPS) : at + 1], texts[number][at : at + STEPS]
        kind = KINDS[turn % len(KINDS)]
        datum = invented(kind, rng)
        if turn >= INVENTED:
            window(before, lookalike(rng), _pick(rng, "", ",", ".") + after, 0)
        else:
            form = datum if turn % 20 < len(KINDS) else _rewritten(kind, datum, rng)
            window(before, form, _pick(rng, "", "", ",", ".") + after, 1 + KINDS.index(kind))
    if not rows:
        none = np.zeros((STEPS, 0), dtype=np.int64)
        return none, none
    return np.stack([r[0] for r in rows], axis=1).astype(np.int64), np.stack([r[1] for r in rows], axis=1)


def learn(texts: list[str], batches: int = BATCHES) -> Tagger | None:
    """A network trained on labelled spans in some texts; None if there is no place for any."""
    classes, labels = learning_windows(texts)
    if not labels.any():
        return None
    network = Tagger.new(_CLASSES, 1 + len(KINDS))
    network.train(classes, labels, -(-batches * BATCH // classes.shape[1]), BATCH)
    return network


def learning_texts(docs: DataFrame) -> list[str]:
    """A bounded sample of texts, drawn by hash: most with digits or address signs, some without."""
    fit = docs.where(F.length("text").between(1, LEARNED_CHARS)).select("doc_id", "text")
    marked, count = F.col("text").rlike("[0-9@]"), F.count_if
    found = fit.agg(count(marked).alias("marked"), count(~marked).alias("plain")).first()
    texts = []
    for chosen, rows, most in ((marked, found["marked"], MARKED_ROWS), (~marked, found["plain"], PLAIN_ROWS)):
        share = min(1.0, most / max(rows, 1))
        # A share of about ``most`` rows; the limit only bounds what equal rows could add to it.
        part = fit.where(chosen & drawn(share, "doc_id", "text")).select("text").limit(2 * most)
        texts += sorted(row["text"] for row in part.collect())
    return texts


_SHAPES = {
    "email": re.compile(
        r"(?:[A-Za-z0-9._%+-]+ dot )?[A-Za-z0-9._%+-]+ ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]+(?:(?:\.|\[\.\]| dot )[A-Za-z0-9-]+)+", re.IGNORECASE
    ),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?: ?\. ?|\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])(?:(?:[0-9]{4}[ ./-]){3}[0-9]{4}|[0-9]{13,19})(?![0-9])"),
    "phone": re.compile(r"(?:\+|\()?(?<![0-9])[0-9](?:[ ().-]{0,2}[0-9]){6,14}(?![0-9])"),
}


# What every form above contains, in any cut of the text that holds the form.
_DOT = r"(?: ?\. ?|\[\.\]|\(\.\))"
_SIGNS_OF_FORMS = (
    re.compile(r"(?:@|[(\[ ]at[)\] ]) ?[A-Za-z0-9-]++(?:\.|\[\.\]| dot )[A-Za-z0-9-]", re.IGNORECASE),
    re.compile(
        rf"[0-9](?:[ ().-]{{0,2}}[0-9]){{6}}|[0-9](?:{_DOT}[0-9]{{1,3}}){{2}}{_DOT}[0-9]|(?:[0-9]{{4}}[ ./-]){{3}}[0-9]{{4}}"
    ),
)


def signs_of_forms(text: str) -> list[tuple[int, int]]:
    """Places (start, end) such that whatever fits a form of some kind overlaps one of them."""
    return [m.span() for sign in _SIGNS_OF_FORMS for m in sign.finditer(text)]


def _plausible(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(int(part) <= 255 for part in re.findall("[0-9]+", text))
    if kind == "card":
        return luhn(_digits(text))
    return kind == "email" or len(_digits(text)) < len(text)


def fitted(kind: str, text: str, start: int, end: int) -> tuple[int, int] | None:
    """The form of its kind that a span touches, in the words that it lies in; None if there is none."""
    low, high = max(0, start - OVERLAP // 2), min(len(text), end + OVERLAP // 2)
    # Words that reach further than that begin or end where the search does.
    low += len(text[low:start]) - len(re.search(r"\S*\Z", text[low:start])[0])
    high = end + len(re.match(r"\S*", text[end:high])[0])
    while found := _SHAPES[kind].search(text, low, high):
        if found.start() < end and start < found.end() and _plausible(kind, found[0]):
            return found.start(), found.end()
        low = found.start() + 1
    return None


def reconcile(windows: list[tuple[int, int, int, int]], count: int, length: int) -> list[tuple[int, int, int]]:
    """Spans (start, end, label) of the stream from spans (window, start, end, label) of its windows."""
    edge, kept = OVERLAP // 2, []
    for window, start, end, label in windows:
        at = window * (WINDOW - OVERLAP)
        low = at + edge if window else 0
        high = at + WINDOW - edge if window + 1 < count else length
        if low <= (start + end) // 2 < high:
            kept.append((start, end, label))
    united: list[tuple[int, int, int]] = []
    for start, end, label in sorted(kept):
        if united and start < united[-1][1]:
            before = united[-1]
            if before[2] == label:
                united[-1] = (before[0], max(before[1], end), label)
            elif end - start > before[1] - before[0]:
                united[-1] = (start, end, label)
        else:
            united.append((start, end, label))
    return united


def _near(places: list[list[tuple[int, int]]], owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each window of a text (its ``owner``), whether a place of that text overlaps ``low`` to ``high``."""
    out = np.zeros(len(owner), dtype=bool)
    first = np.searchsorted(owner, np.arange(len(places) + 1))
    for text, held in enumerate(places):
        if held:
            own = slice(first[text], first[text + 1])
            starts, ends = (np.sort(side) for side in np.array(held).T)
            out[own] = np.searchsorted(starts, high[own]) > np.searchsorted(ends, low[own], side="right")
    return out


def window_spans(
    network: Tagger, texts: list[str], places: list[list[tuple[int, int]]] | None = None
) -> list[list[tuple[int, int, int]]]:
    """Spans (start, end, label) that the network sees, per text, each text in windows of its own.

    With ``places`` per text, only windows that have one within ``REACH`` characters are decoded.
    """
    step, lengths = WINDOW - OVERLAP, np.array([len(text) for text in texts])
    counts = np.maximum(1, -(-(lengths - OVERLAP) // step))
    line = np.concatenate([*map(symbols, texts), np.zeros(WINDOW, dtype=np.int8)])
    owner = np.repeat(np.arange(len(texts)), counts)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at, left = (np.cumsum(lengths) - lengths)[owner] + turn * step, lengths[owner] - turn * step
    widths = np.minimum(WINDOW, -(-left // WIDTH) * WIDTH)
    if places is not None:
        widths[~_near(places, owner, turn * step - REACH, turn * step + widths + REACH)] = 0
    found: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    for width in range(WIDTH, WINDOW + 1, WIDTH):
        every = np.flatnonzero(widths == width)
        for chosen in np.split(every, range(STREAM // width, len(every), STREAM // width)):
            if not len(chosen):
                continue
            place = np.arange(width)[:, None]
            classes = np.where(place < left[chosen], line[at[chosen] + place], 0)
            best = network.decode(classes.astype(np.int64))
            for column in np.flatnonzero(best.any(axis=0)).tolist():
                labels = np.concatenate([[0], best[:, column], [0]])
                turns = np.flatnonzero(labels[1:] != labels[:-1])
                number = int(turn[chosen[column]])
                found[owner[chosen[column]]] += [
                    (number, number * step + a, number * step + b, int(labels[a + 1]))
                    for a, b in zip(turns[:-1].tolist(), turns[1:].tolist(), strict=True)
                    if labels[a + 1]
                ]
    return [reconcile(f, int(n), int(m)) for f, n, m in zip(found, counts, lengths, strict=True)]


def added_spans(network: Tagger, texts: list[str]) -> list[list[Span]]:
    """Spans that the network finds, per text, fitted to a form of their kind."""
    out: list[list[Span]] = [[] for _ in texts]
    places = [signs_of_forms(text) for text in texts]
    chosen = [number for number, held in enumerate(places) if held]
    last = 0
    while last < len(chosen):
        first, size = last, 0
        while last < len(chosen) and (last == first or size + len(texts[chosen[last]]) < STREAM):
            size += len(texts[chosen[last]])
            last += 1
        group = chosen[first:last]
        for number, seen in zip(group, window_spans(network, [texts[n] for n in group], [places[n] for n in group]), strict=True):
            text, kept = texts[number], out[number]
            fits = ((KINDS[label - 1], fitted(KINDS[label - 1], text, start, end)) for start, end, label in seen)
            for kind, place in fits:
                if place and not any(place[0] < e and s < place[1] for _, s, e in kept[-2:]):
                    kept.append((kind, *place))
    return out


def spans(texts: list[str], network: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, by kind and start."""
    added = added_spans(network, texts) if network is not None else [[] for _ in texts]
    out = []
    for text, more in zip(texts, added, strict=True):
        base = base_spans(text)
        free = [s for s in more if all(s[2] <= b[1] or s[1] >= b[2] for b in base)]
        out.append((base, sorted([*base, *free], key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def _texts(batch: pa.RecordBatch) -> list[str]:
    return ["" if text is None else text for text in batch.column("text").to_pylist()]


_SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) for every row: base spans and all spans, by kind and start, ends exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(learning_texts(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = spans(_texts(batch), shared.value)
            named = [[[dict(zip(("kind", "start", "end"), s, strict=True)) for s in side] for side in both] for both in found]
            columns = [pa.array([both[k] for both in named], _SPAN_TYPE) for k in (0, 1)]
            yield pa.record_batch([batch.column("doc_id"), *columns], names=["doc_id", "base", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id bigint, base {_SPANS}, spans {_SPANS}"
    )


def masked(text: str, found: list[Span]) -> str:
    """The text with each span, overlapping ones united, replaced by its kind in brackets."""
    out, done = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns, with personal data in ``text`` replaced; null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(learning_texts(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = spans(_texts(batch), shared.value)
            texts = [
                None if text is None else masked(text, every)
                for text, (_, every) in zip(batch.column("text").to_pylist(), found, strict=True)
            ]
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
