"""A self-contained HTML dashboard of a run (K11, F33, F34, A27): key figures, counters with filters and a search,
trends over runs, insights, and messages behind each counter; all content escaped."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Mapping, Sequence
from typing import Any

# Limits of the insights.
FRICTION_SHARE, ANSWERED_LOW, ANSWERED_GOOD = 0.15, 0.5, 0.7


def insights(document: Mapping[str, Any]) -> list[tuple[str, str]]:
    """(level, sentence) of what stands out."""
    out = []
    total = document.get("metadata", {}).get("total_messages") or 0
    friction = sum(document.get("friction_signals", {}).values())
    if total and friction / total > FRICTION_SHARE:
        out.append(("warn", f"Friction is named in {friction / total:.0%} of the messages."))
    rate = document.get("help_answered", {}).get("rate")
    if rate is not None:
        level = "good" if rate >= ANSWERED_GOOD else "warn" if rate < ANSWERED_LOW else "info"
        out.append((level, f"{rate:.0%} of the questions in the target language were answered within two days."))
    for section, said in (("features", "Most named feature"), ("competitors", "Most named alternative"), ("friction_signals", "Most frequent friction")):
        counts = document.get(section) or {}
        if counts:
            key, n = max(counts.items(), key=lambda kv: (kv[1], kv[0]))
            out.append(("info", f"{said}: {key} ({n:g})."))
    return out


def kpis(document: Mapping[str, Any], previous: Mapping[str, Any] | None = None) -> list[tuple[str, float | None, float | None]]:
    """(name, value, change to the run before) of the key figures."""

    def figures(d: Mapping[str, Any]) -> dict[str, float | None]:
        languages = d.get("language_distribution", {})
        return {
            "Messages": d.get("metadata", {}).get("total_messages"), "Users": d.get("users", {}).get("total"), "Target language": sum(languages.get(k, 0) for k in ("target", "mixed")),
            "Friction": sum(d.get("friction_signals", {}).values()), "Active in 30 days": d.get("retention", {}).get("active_30d"), "Answered": d.get("help_answered", {}).get("rate"),
        }

    now, before = figures(document), figures(previous) if previous is not None else {}
    return [(k, v, v - before[k] if v is not None and before.get(k) is not None else None) for k, v in now.items()]


def terms(keywords: Sequence[str]) -> list[str]:
    """plain texts that a label's keywords stand for, in lower case: alternatives and optional letters of the
    patterns are written out, other signs of patterns fall away."""
    out: list[str] = []
    for keyword in keywords:
        plain = re.sub(r"\\b|\(\?[:!<=]+[^)]*\)|[\^$]", "", keyword).replace(r"\s", " ").replace(r"\+", "\0")
        whole = [""]
        for piece in re.finditer(r"\(([^()]*)\)(\??)|(\\?.)(\?)?", plain):
            if piece.group(1) is not None:
                options = piece.group(1).split("|") + ([""] if piece.group(2) else [])
            else:
                letter = piece.group(3).lstrip("\\")
                options = [letter] + ([""] if piece.group(4) else [])
            whole = [w + o for w in whole for o in options][:64]
        out += [w for text in whole for w in text.replace("\0", "+").replace("*", "").lower().split("|") if w.strip()]
    return list(dict.fromkeys(out))


def bars(title: str, counts: Mapping[str, float], previous: Mapping[str, float] | None = None, n: int = 20) -> str:
    """The n largest counters as bars, with the change to the run before."""
    top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
    most = max((v for _, v in top), default=0) or 1
    rows = []
    for key, value in top:
        change = "" if previous is None else f" <small>({value - previous.get(key, 0):+g})</small>"
        rows.append(f'<tr data-key="{html.escape(str(key))}"><th>{html.escape(str(key))}</th><td><div class="bar" style="width:{value / most * 100:.1f}%"></div></td><td>{value:g}{change}</td></tr>')
    return f'<section data-title="{html.escape(title)}"><h2>{html.escape(title)}</h2><table>{"".join(rows)}</table></section>'


def trend(title: str, values: Sequence[float | None]) -> str:
    """A counter over runs as an SVG line; a run without a value leaves a gap."""
    known = [v for v in values if v is not None]
    if len(known) < 2:
        return ""
    low, high = min(known), max(known)
    x = lambda k: 10 + k * 280 / (len(values) - 1)
    y = lambda v: 50 - (v - low) / ((high - low) or 1) * 40
    points = " ".join(f"{x(k):.1f},{y(v):.1f}" for k, v in enumerate(values) if v is not None)
    return f'<figure><figcaption>{html.escape(title)}: {known[0]:g} to {known[-1]:g}</figcaption><svg viewBox="0 0 300 60"><polyline fill="none" stroke="#47a" stroke-width="2" points="{points}"/></svg></figure>'


_STYLE = (
    "body{font-family:sans-serif;margin:2em}table{width:100%}th{text-align:left;width:14em}.bar{background:#47a;height:1em}.warn{color:#a30}.good{color:#073}"
    "dl{display:flex;gap:2em;flex-wrap:wrap}dt{color:#666}dd{margin:0;font-size:1.5em}tr{cursor:pointer}figure{display:inline-block;width:18em;margin:.5em}[hidden]{display:none}#messages li{white-space:pre-wrap}"
)
# The script reads what the page carries as JSON and writes it as text only.
_SCRIPT = """
const data = JSON.parse(document.getElementById('stats').textContent), byId = id => document.getElementById(id);
const sections = [...document.querySelectorAll('section[data-title]')];
for (const s of sections) byId('section').append(new Option(s.dataset.title, s.dataset.title));
function filter() {
  const chosen = byId('section').value, word = byId('word').value.toLowerCase();
  for (const s of sections) {
    let left = 0;
    for (const row of s.querySelectorAll('tr')) { row.hidden = word !== '' && !row.dataset.key.toLowerCase().includes(word); left += !row.hidden; }
    s.hidden = (chosen !== '' && s.dataset.title !== chosen) || left === 0;
  }
}
function drill(key) {
  const words = data.terms[key] || [key.toLowerCase().replaceAll('_', ' ')], list = byId('messages');
  const hits = data.messages.filter(m => words.some(w => m.content.toLowerCase().includes(w))).slice(0, 50);
  list.replaceChildren(...hits.map(m => { const li = document.createElement('li'); li.textContent = (m.ts || '') + ' ' + m.author_name + ': ' + m.content; return li; }));
  byId('drilled').textContent = key + ': ' + hits.length + ' of the messages carried here';
}
byId('section').onchange = byId('word').oninput = filter;
for (const row of document.querySelectorAll('tr[data-key]')) row.onclick = () => drill(row.dataset.key);
"""


def page(
    document: Mapping[str, Any], title: str, runs: Sequence[Mapping[str, Any]] = (), samples: Mapping[str, Sequence[str]] | None = None, messages: Sequence[Mapping[str, Any]] = (),
    keywords: Mapping[str, Mapping[str, Sequence[str]]] | None = None, titles: Mapping[str, str] | None = None,
) -> str:
    """The page of the latest run. `runs` are earlier documents, oldest first; `samples` messages by label; `messages`
    (author_name, ts, content; a sample of bounded size) are what a click on a counter searches, by the terms of `keywords`;
    `titles` names sections."""
    last = runs[-1] if runs else {}
    shown = {n: c for n, c in document.items() if n not in ("metadata", "urls") and isinstance(c, Mapping) and c and all(isinstance(v, (int, float)) for v in c.values())}
    shown |= {f"urls: {n}": c for n, c in document.get("urls", {}).items()}
    before = lambda n: last.get("urls", {}).get(n[6:], {}) if n.startswith("urls: ") else last.get(n, {})
    sections = [bars((titles or {}).get(n, n), c, before(n) if runs else None) for n, c in shown.items()]
    figures = "".join(f"<div><dt>{html.escape(n)}</dt><dd>{'-' if v is None else f'{v:.3g}' if isinstance(v, float) and not v.is_integer() else f'{v:g}'}{'' if d is None else f' <small>({d:+.3g})</small>'}</dd></div>" for n, v, d in kpis(document, last if runs else None))
    lines = "".join(trend(n, [dict((k, v) for k, v, _ in kpis(d)).get(n) for d in (*runs, document)]) for n, _, _ in kpis(document)) if runs else ""
    notes = "".join(f'<li class="{level}">{html.escape(text)}</li>' for level, text in insights(document))
    drill = "".join(f"<details><summary>{html.escape(k)}</summary><ul>{''.join(f'<li>{html.escape(s)}</li>' for s in v)}</ul></details>" for k, v in (samples or {}).items())
    carried = {"stats": document, "messages": [{k: str(m.get(k) or "") for k in ("author_name", "ts", "content")} for m in messages], "terms": {label: terms(words) for some in (keywords or {}).values() for label, words in some.items()}}
    data = json.dumps(carried, ensure_ascii=False, default=str).replace("<", "\\u003c")
    return (
        f'<!doctype html><html lang="en"><meta charset="utf-8"><title>{html.escape(title)}</title><style>{_STYLE}</style><h1>{html.escape(title)}</h1><dl>{figures}</dl>{lines}<ul>{notes}</ul>'
        f'<p><select id="section"><option value="">all</option></select> <input id="word" placeholder="filter"></p>{"".join(sections)}<h2 id="drilled"></h2><ul id="messages"></ul>{drill}'
        f'<script type="application/json" id="stats">{data}</script><script>{_SCRIPT}</script></html>'
    )
