"""Plain step-by-step models of the operators, for small inputs."""

from __future__ import annotations

from collections import defaultdict


def split(line: str, separators: str) -> list[str]:
    words, word = [], ""
    for char in line:
        if char in separators:
            words.append(word)
            word = ""
        else:
            word += char
    words.append(word)
    if len(words) == 1:
        return words
    while words and words[-1] == "":
        words.pop()
    return words


def running(records):
    """``(key, seq, value)`` -> ``(key, seq, sum so far, largest so far)``."""
    seen = defaultdict(list)
    out = []
    for key, seq, value in sorted(records, key=lambda r: r[1]):
        seen[key].append(value)
        out.append((key, seq, sum(seen[key]), max(seen[key])))
    return out


def alarms(orders, within_ms):
    """``(user, seq, ts, state)`` -> alarming ``(user, seq)``."""
    armed = {}
    out = []
    for user, seq, ts, state in sorted(orders, key=lambda o: o[1]):
        at = armed.pop(user, None)
        if at is not None and ts < at + within_ms:
            if state == 2:
                out.append((user, seq))
        elif state == 2:
            armed[user] = ts
    return out


def emitted(records, horizon_ms, fires):
    """``(key, seq, ts)`` -> ``(key, seq, count in the horizon)``."""
    kept = defaultdict(list)
    started = set()
    out = []
    for key, seq, ts in sorted(records, key=lambda r: r[1]):
        kept[key] = [t for t in kept[key] if t > ts - horizon_ms] + [ts]
        if key in started and fires(key, seq):
            out.append((key, seq, len(kept[key])))
        started.add(key)
    return out


def lateness(records, width, bound, late):
    """``(seq, ts)`` in arrival order -> ``(seq, window end, class)``."""
    latest = None
    out = []
    for seq, ts in sorted(records):
        end = ts // width * width + width
        if latest is None or end - 1 > latest - bound - 1:
            kind = "on_time"
        elif end - 1 + late > latest - bound - 1:
            kind = "allowed_late"
        else:
            kind = "too_late"
        out.append((seq, end, kind))
        latest = ts if latest is None else max(latest, ts)
    return out


def changelog(amounts):
    """``(seq, amount or None)`` -> ``(seq, ord, op, total)``."""
    out = []
    total, first = None, True
    for seq, amount in sorted(amounts, key=lambda a: a[0]):
        new = total if amount is None else (total or 0) + amount
        if first:
            out.append((seq, 0, "+I", new))
        elif new != total:
            out += [(seq, 0, "-U", total), (seq, 1, "+U", new)]
        total, first = new, False
    return out


def late_batches(batches, width, bound, late, first):
    """Micro-batches of ``(seq, ts, word, cnt)`` -> main and late rows; the watermark
    moves between batches, and the batches are followed by empty ones."""
    windows, main, side = {}, [], []
    latest = None

    def fire(word, end):
        window = windows[word, end]
        main.append((word, window["first"][1] if first else window["total"], end))

    for batch in [*batches, []]:
        wm = None if latest is None else latest - bound
        if wm is not None:
            for (word, end), window in sorted(windows.items()):
                if end <= wm and not window["fired"]:
                    window["fired"] = True
                    fire(word, end)
        for seq, ts, word, cnt in sorted(batch):
            end = ts // width * width + width
            is_late = wm is not None and end <= wm
            if is_late and end + late <= wm:
                side.append((word, cnt, end))
                continue
            window = windows.setdefault(
                (word, end), {"total": 0, "first": (seq, cnt), "fired": is_late}
            )
            window["total"] += cnt
            window["first"] = min(window["first"], (seq, cnt))
            if is_late:
                window["fired"] = True
                fire(word, end)
        latest = max([ts for _, ts, _, _ in batch] + ([latest] if latest is not None else []), default=latest)
    return sorted(main), sorted(side)
