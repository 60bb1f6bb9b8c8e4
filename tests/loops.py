"""Brute force: the operators as plain loops over lists of dicts, for small panels only."""

from __future__ import annotations

from collections import Counter, defaultdict


def number(cell):
    """Truncated number or None."""
    if cell is None:
        return None
    try:
        return int(float(cell))
    except (ValueError, OverflowError):
        return None


def dirty(cell):
    return cell is not None and number(cell) is None


def grouped(rows, *keys):
    out = defaultdict(list)
    for r in rows:
        out[tuple(r[k] for k in keys)].append(r)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r["Date"], r["_ord"]))


def fill(rows, grid, blank):
    out = [dict(r) for r in rows]
    for own in grouped(rows, "State").values():
        present = sorted({r["Date"] for r in own})
        for g in grid:
            earlier = [d for d in present if d < g]
            if g in present or not earlier:
                continue
            out += [{**r, "Date": g, **{c: None for c in blank}} for r in own if r["Date"] == earlier[-1]]
    return out


def close(rows, current):
    out = [{**r, "last_recorded": r["Date"]} for r in rows]
    for own in grouped(rows, "State").values():
        for d in sorted({r["Date"] for r in own}):
            for entity in {r["ctp_id"] for r in own}:
                seen = sorted({r["Date"] for r in own if r["ctp_id"] == entity and r["Date"] <= d})
                if seen and seen[-1] < d:
                    first = min((r for r in own if r["ctp_id"] == entity and r["Date"] == seen[-1]),
                                key=lambda r: r["_ord"])
                    out.append({**first, "Date": d, "last_recorded": seen[-1], "Outbrk_Status": "Closed",
                                **{c: None for c in current}})
    return out


def repair(rows, running, markers):
    out = [{**r, **{c: None if r[c] is None else r[c].lower() for c in running}} for r in rows]
    for own in grouped(out, "State", "ctp_id").values():
        for d in sorted({r["Date"] for r in own}):
            before = [x for x in {r["Date"] for r in own} if x < d]
            source = min((r for r in own if r["Date"] == max(before)), key=lambda r: r["_ord"]) if before else {}
            for r in own:
                if r["Date"] == d:
                    for c in running:
                        if r[c] in markers:
                            r[c] = source.get(c)
    return out


def content(r):
    return tuple(sorted((k, v) for k, v in r.items() if k != "_ord" and v is not None))


def collapse_adding(rows, pairs, add=True):
    out = []
    for slot in grouped(rows, "State", "ctp_id", "Date").values():
        opened = sorted((r for r in slot if r["Outbrk_Status"] == "OPEN"), key=lambda r: r["_ord"])
        kept = opened[0] if opened else min(slot, key=lambda r: r["_ord"])
        if (len({content(r) for r in opened}) > 1 or any(dirty(r[c]) for r in slot for c, _ in pairs)
                or any(dirty(kept[o]) for _, o in pairs)):
            out += slot
            continue
        merged = dict(kept)
        for c, o in pairs:
            total = sum(number(r[c]) or 0 for r in slot) + ((number(kept[o]) or 0) if add else 0)
            if total > 0:
                merged[c] = total
        out.append(merged)
    return out


def merge_pairs(rows, pairs, types=None):
    out = []
    for slot in grouped(rows, "State", "ctp_id", "Date").values():
        slot = sorted(slot, key=lambda r: r["_ord"])
        opened = [r for r in slot if r["Outbrk_Status"] == "OPEN"]
        if len(slot) != 2 or (types and slot[0]["State_Facility_Type"].upper() not in types):
            out += slot
        elif content(slot[0]) == content(slot[1]):
            out.append(slot[0])
        elif len(opened) == 1:
            other = next(r for r in slot if r is not opened[0])
            out.append({**opened[0], **{c: other[c] for c, _ in pairs}})
        else:
            out += slot
    return out


def carry(rows, pairs, since):
    out = []
    for own in grouped(rows, "State", "ctp_id").values():
        own = [dict(r) for r in in_order(own)]
        hits = [i for i in range(1, len(own)) if own[i]["Date"] >= since
                and own[i]["Outbrk_Status"] == "CLOSED" and own[i - 1]["Outbrk_Status"] == "OPEN"]
        if hits:
            event = {c: number(own[hits[-1] - 1][o]) for c, o in pairs}
            for r in own[hits[-1]:]:
                for c, _ in pairs:
                    if not dirty(r[c]) and event[c] is not None:
                        r[c] = (number(r[c]) or 0) + event[c]
        out += own
    return out


def past_events(rows, pairs, skip=True):
    out = []
    for own in grouped(rows, "State", "ctp_id").values():
        own = in_order(own)
        total, spoilt = None, set()
        for i, r in enumerate(own):
            if i > (1 if skip else 0) and (r["Outbrk_Status"] or "").upper() == "OPEN" \
                    and (own[i - 1]["Outbrk_Status"] or "").upper() == "CLOSED":
                total = total or {c: 0 for c, _ in pairs}
                total = {c: total[c] + (number(own[i - 1][c]) or 0) for c, _ in pairs}
                spoilt |= {c for c, _ in pairs if dirty(own[i - 1][c])}  # a closed total that is text
            new = dict(r)
            if total:
                for c, _ in pairs:
                    if c not in spoilt and not dirty(r[c]):
                        value = total[c] + (number(r[c]) or 0)
                        new[c] = value if value > 0 else None
            out.append(new)
    return out


def undo_reset(rows, pairs, reset):
    out, leavers = [], set()
    for own_state in grouped(rows, "State").values():
        listed = sorted({r["Date"] for r in own_state if r["Date"] > reset.listed_after})
        for own in grouped(own_state, "ctp_id").values():
            dates = {r["Date"] for r in own}
            started = [d for d in listed if d in dates]
            gap = bool(started) and any(d not in dates for d in listed if d >= started[0])
            base_rows = sorted((r for r in own if r["Date"] == reset.base_date), key=lambda r: r["_ord"])
            if gap or not base_rows:
                if not gap:
                    leavers |= {(r["State"], r["Facility"]) for r in own}
                out += own
                continue
            first = min(own, key=lambda r: r["_ord"])
            metrics = [m for p in pairs for m in p]
            added = [{**first, "Date": d, **{m: None for m in metrics}} for d in listed if d not in dates]
            for r in [*own, *added]:
                new = dict(r)
                for c in reset.columns:
                    if r["Date"] >= reset.correct_from and not dirty(r[c]) and not dirty(base_rows[0][c]):
                        base = number(base_rows[0][c])
                        new[c] = None if base is None else base + (number(r[c]) or 0)
                out.append(new)
    return out, leavers


def falling(rows, running, meaning, junk, this_week=False):
    def cell(r, c):
        v = r[c]
        if c == "Cume_Res_Pos" and r["State"] == "RI" and v is not None:
            v = v.split(" ")[0]
            v = v if v.lstrip("+-").isdigit() else None
        if c == "Cume_Res_Death" and r["State"] == "RI":
            v = "-1"
        v = "-1" if v is None else v
        if c == "Cume_ResStaff_Pos" and r["State"] == "MA":
            v = "-1"
        return str(meaning.get(v, v))

    clean = [{**r, **{c: cell(r, c) for c in running}} for r in rows]
    clean = [r for r in clean if not any(r[c] in junk for c in running)]
    latest = {k[0]: max(r["Date"] for r in g) for k, g in grouped(clean, "State").items()}
    out = []
    for own in grouped(clean, "State", "ctp_id").values():
        own = in_order(own)
        for a, b in zip(own, own[1:]):
            for c in running:
                was, now = number(a[c]), number(b[c])
                if was is None or now is None or now == -1 or now >= was:
                    continue
                if this_week and b["Date"] != latest[b["State"]]:
                    continue
                out.append({"State": b["State"], "Facility": b["Facility"], "cumulative_field_decreased": c,
                            "Date": b["Date"], "current_cumulative_value": now, "Prev Date": a["Date"],
                            "prev_cumulative_value": was, "CTP_Facility_Type": b["CTP_Facility_Type"],
                            "ctp_id": b["ctp_id"]})
    return out


def mode(values):
    counts = Counter(values)
    most = max(counts.values())
    return min(v for v, n in counts.items() if n == most)


def peer_types(rows):
    out = []
    for r in rows:
        new = dict(r)
        peers = [p for p in rows if p["State"] == r["State"] and p["Facility"] == r["Facility"]
                 and p["State_Facility_Type"] not in ("", None)]
        kinds = [p["State_Facility_Type"] for p in peers]
        if r["State_Facility_Type"] == "" and kinds and not ("NH" in kinds and {"ALF", "ICF"} & set(kinds)):
            new["State_Facility_Type"] = mode(kinds)
            ids = [p["CMS_ID"] for p in peers if p["CMS_ID"] is not None]
            if new["State_Facility_Type"] == "NH" and ids:
                new["CMS_ID"] = mode(ids)
        out.append(new)
    return out


def peer_counties(rows):
    out = []
    for r in rows:
        new = dict(r)
        if r["County"] == "":
            found = {p["County"] for p in rows if p["State"] == r["State"] and p["Facility"] == r["Facility"]
                     and p["County"] != "" and r["State_Facility_Type"] in ("", p["State_Facility_Type"])}
            if len(found) == 1:
                new["County"] = found.pop()
        out.append(new)
    return out


def open_duplicates(rows, differ, alike):
    out = []
    for slot in grouped(rows, "State", "ctp_id", "Date").values():
        opened = [r for r in slot if r["Outbrk_Status"] == "OPEN"]
        if len(opened) > 1:
            kinds = {content(r): r for r in opened}
            out += [{**r, "error": differ if len(kinds) > 1 else alike} for r in kinds.values()]
    return out


def same_data(rows, metrics, message):
    out = []
    for own in grouped(rows, "State", "Date", *metrics).values():
        if len(own) > 1:
            out += [{**r, "error": message} for r in own]
    return out


