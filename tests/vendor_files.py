"""Small archive trees in the vendor layout."""

import os
import zipfile
from datetime import date

from panelwright.specs import END_OF_FILE


def member_text(header, rows, skip, trailer=END_OF_FILE):
    lines = [f"preamble {i}" for i in range(skip)] + ["|".join(header)]
    lines += ["|".join("" if v is None else str(v) for v in r) for r in rows]
    return "\n".join([*lines, trailer, ""])


def write_zip(path, members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    mode = "a" if os.path.exists(path) else "w"
    with zipfile.ZipFile(path, mode, zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)


def header_of(spec):
    return spec.raw.fieldNames()


def put_daily(root, spec, session, rows):
    text = member_text(header_of(spec), rows, spec.skip_lines)
    write_zip(os.path.join(root, spec.daily_archive(session)), {spec.daily_member(session): text})


def put_history(root, spec, year, rows_by_session, suffix=""):
    stem = f"{spec.history_folder}/{spec.history_zip}_{year}{suffix}.zip"
    members = {spec.daily_member(s): member_text(header_of(spec), rows, spec.skip_lines) for s, rows in rows_by_session.items()}
    members[f"other_{spec.name}.{year}"] = "noise\n"
    write_zip(os.path.join(root, stem), members)


def ymd(d: date) -> str:
    return f"{d:%Y%m%d}"
