"""Project settings: an ini file found in a folder or one above it, with typed defaults."""

from __future__ import annotations

import configparser
from dataclasses import dataclass, fields, replace
from pathlib import Path

FILE = "strandline.ini"


@dataclass(frozen=True)
class Project:
    name: str = ""
    threads: int = 4
    min_length: int = 1000
    chunk_size: int = 10_000
    verbose: bool = False


def find(start: str | Path = ".") -> Path | None:
    here = Path(start).resolve()
    return next((d / FILE for d in (here, *here.parents) if (d / FILE).is_file()), None)


def load(start: str | Path = ".") -> Project:
    """The project of a folder; defaults where there is no file. Unknown keys and wrong types are errors."""
    path = find(start)
    if path is None:
        return Project()
    ini = configparser.ConfigParser()
    ini.read(path)
    out = Project()
    kinds = {f.name: type(getattr(out, f.name)) for f in fields(Project)}
    for key in ini["project"] if ini.has_section("project") else ():
        if key not in kinds:
            raise ValueError(f"{path}: unknown setting {key}")
        get = {bool: ini["project"].getboolean, int: ini["project"].getint, str: ini["project"].get}[kinds[key]]
        out = replace(out, **{key: get(key)})
    return out


def save(project: Project, folder: str | Path) -> Path:
    ini = configparser.ConfigParser()
    ini["project"] = {f.name: str(getattr(project, f.name)) for f in fields(Project)}
    path = Path(folder) / FILE
    with open(path, "w") as f:
        ini.write(f)
    return path
