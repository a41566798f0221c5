"""Plain-Python models of the naming and text rules, written from their specification."""

import re

MAX = 180


def flat_name(rel_path: str, max_bytes: int = MAX) -> str:
    parts = rel_path.split("/")
    dirs, base = parts[:-1], parts[-1]
    for drop in range(len(dirs) + 1):
        name = "__".join(dirs[drop:] + [base])
        if len(name.encode("utf-8")) <= max_bytes:
            return name
    return base


def page_stem(parts: list[str]) -> str:
    cleaned = []
    for p in parts:
        for ch in '/\\:*?"<>|':
            p = p.replace(ch, "_")
        cleaned.append(p.replace("__", "_"))
    return "__".join(cleaned).strip("_.")


def markdown(html: str) -> str:
    out = html
    for i in range(6, 0, -1):
        out = out.replace(f"<h{i}>", "\n" + "#" * i + " ").replace(f"</h{i}>", "\n")
    for a, b in [("<p>", "\n\n"), ("</p>", "\n"), ("<br>", "\n"), ("<br/>", "\n"), ("<ul>", "\n"),
                 ("</ul>", "\n"), ("<ol>", "\n"), ("</ol>", "\n"), ("<li>", "- "), ("</li>", "\n")]:
        out = out.replace(a, b)
    return re.sub(r"<[^>]+>", "", out)


def in_build_dir(rel_path: str) -> bool:
    return any(d in (".git", "target") for d in rel_path.split("/")[:-1])
