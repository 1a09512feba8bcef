"""Plain-Python statement of the lifecycle / daily / monthly semantics, for
comparing the Spark operators on small fixtures (row by row, no Spark)."""
import datetime as dt
from collections import defaultdict

ONE = dt.timedelta(days=1)


def lifecycle(entries, types, aliases):
    """entries: dicts with incident_id, comment_seq, comment_div, comment_by, comment_date, comment."""
    tmap = {t[0]: t for t in types}
    amap = dict(aliases)
    by_case = defaultdict(list)
    for e in entries:
        t = tmap.get(e["comment_div"])
        r = dict(e)
        r.update(comment_div_adj=t[0] if t else "others", ball_on=t[1] if t else "unknown",
                 is_closer=bool(t[2]) if t else False, is_approver=bool(t[3]) if t else False,
                 is_patch_planned=bool(t[4]) if t else False, is_response=bool(t[5]) if t else False)
        by_case[e["incident_id"]].append(r)
    out = []
    for cid, rows in by_case.items():
        rows.sort(key=lambda r: r["comment_seq"])
        seqs = [r["comment_seq"] for r in rows]
        resp = [r["comment_seq"] for r in rows if r["is_response"]]
        no_appr = [r["comment_seq"] for r in rows if not r["is_approver"]]
        no_close = [r["comment_seq"] for r in rows if not (r["is_closer"] or r["is_approver"])]
        min_resp = min(resp) if resp else None
        mx_na = max(no_appr) if no_appr else None
        mx_nc = max(no_close) if no_close else None
        for i, r in enumerate(rows):
            s = r["comment_seq"]
            lead = rows[i + 1]["comment_date"] if i + 1 < len(rows) else None
            fc = (r["is_closer"] or r["is_approver"]) and mx_nc is not None and s == mx_nc + 1
            fa = r["is_approver"] and mx_na is not None and s == mx_na + 1
            nxt = (lead if lead is not None else r["comment_date"]) if (fc or fa) else lead
            out.append(dict(
                incident_id=cid, comment_seq=s, comment_id=f"{cid}_{s:04d}",
                comment_div=r["comment_div_adj"], comment_by=amap.get(r["comment_by"], r["comment_by"]),
                comment_date=r["comment_date"], next_comment_date=nxt,
                days_after_comment=(nxt - r["comment_date"]).days if nxt and r["comment_date"] else None,
                ball_on=r["ball_on"], is_first_response=min_resp is not None and s == min_resp,
                is_closer=r["is_closer"], is_final_closer=fc,
                is_after_final_close=mx_nc is not None and s > mx_nc + 1,
                is_approver=r["is_approver"], is_final_approver=fa, is_last_comment=s == max(seqs),
                is_patch_planned=r["is_patch_planned"], is_force_close_announce=False, is_force_close=False))
    return out


def daily(lc, cal_start, as_of):
    groups = defaultdict(list)
    for r in lc:
        if r["is_after_final_close"] or r["comment_date"] is None:
            continue
        n = r["comment_date"] if r["is_final_closer"] else r["next_comment_date"]
        d = max(r["comment_date"], cal_start)
        hi = min(n, as_of) if n is not None else as_of
        while d <= hi:
            groups[(d, r["incident_id"])].append((r, n))
            d += ONE
    out = {}
    for (d, cid), rs in groups.items():
        last = max(rs, key=lambda x: x[0]["comment_seq"])[0]
        def s(f):
            return sum(1 for r, n in rs if f(r, n))
        on = lambda r: d == r["comment_date"]
        out[(d, cid)] = dict(
            comment_id=last["comment_id"], comment_seq=last["comment_seq"], ball_on=last["ball_on"],
            comment_div=last["comment_div"],
            elapsed_days=s(lambda r, n: n is not None and d != n),
            elapsed_days_on_dev=s(lambda r, n: n is not None and d != n and r["ball_on"] == "dev"),
            elapsed_days_on_field=s(lambda r, n: n is not None and d != n and r["ball_on"] == "field"),
            elapsed_days_on_unknown=s(lambda r, n: n is not None and d != n and r["ball_on"] == "unknown"),
            comment_count=s(lambda r, n: on(r)),
            registered_count=s(lambda r, n: on(r) and r["comment_seq"] == 0),
            patch_planned_count=s(lambda r, n: on(r) and r["is_patch_planned"]),
            close_count=s(lambda r, n: on(r) and r["is_final_closer"]),
        )
    return out


def monthly(dl, as_of):
    groups = defaultdict(list)
    for (d, cid), v in dl.items():
        groups[(d.replace(day=1), cid)].append((d, v))
    out = {}
    for (m, cid), rs in groups.items():
        nm = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        snap_day = min(nm - ONE, as_of)
        last = max(rs, key=lambda x: (x[1]["comment_seq"], x[0]))[1]
        snap = [v for d, v in rs if d == snap_day and v["close_count"] == 0]
        out[(m, cid)] = dict(
            comment_id=last["comment_id"], ball_on=last["ball_on"],
            elapsed_days=sum(v["elapsed_days"] for _, v in rs),
            comment_count=sum(v["comment_count"] for _, v in rs),
            month_end_active_count=len(snap),
            month_end_active_count_dev=sum(1 for v in snap if v["ball_on"] == "dev"),
        )
    return out
