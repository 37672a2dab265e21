"""Settings of a deployment: a plain dataclass, read from an INI file where there is one."""

from __future__ import annotations

import configparser
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from urllib.parse import quote, urlsplit, urlunsplit


@dataclass(frozen=True)
class Settings:
    store: str = "store"
    mirror: str = "mirror"
    landing: str = "landing"
    database: str = ""
    first_season: int = 2015
    refresh_days: int = 3
    days_back: int = 3
    batches: int = 1
    discontinued_books: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not 1876 <= self.first_season <= 2100:
            raise ValueError(f"first_season {self.first_season} is no season")
        for name in ("refresh_days", "days_back"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} is negative")
        if self.batches < 1:
            raise ValueError("batches is less than 1")

    @classmethod
    def read(cls, path: str, section: str = "pitlake") -> Settings:
        """The section's values over the defaults; a name that is no setting stops."""
        parser = configparser.ConfigParser()
        with open(path, encoding="utf-8") as f:
            parser.read_file(f)
        given = dict(parser[section]) if parser.has_section(section) else {}
        kinds = {f.name: type(f.default) for f in fields(cls)}
        unknown = sorted(set(given) - set(kinds))
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        listed = lambda text: tuple(x.strip() for x in text.split(",") if x.strip())
        return cls(**{name: listed(text) if kinds[name] is tuple else kinds[name](text) for name, text in given.items()})


def database_url(settings: Settings, environ: Mapping[str, str] = os.environ) -> str:
    """Where the SQL mirror is: PITLAKE_DATABASE_URL, else the setting ``database``.

    PITLAKE_DATABASE_PASSWORD takes the place of the password in it, so that one that changes is kept in no file.
    """
    url = environ.get("PITLAKE_DATABASE_URL") or settings.database
    if not url:
        raise ValueError("no database: set PITLAKE_DATABASE_URL or the setting database")
    parts, password = urlsplit(url), environ.get("PITLAKE_DATABASE_PASSWORD")
    if not parts.scheme or not parts.hostname and parts.scheme != "sqlite":
        raise ValueError("the database's URL names no scheme or no host")
    if password is None:
        return url
    user, _, host = parts.netloc.rpartition("@")
    return urlunsplit(parts._replace(netloc=f"{user.partition(':')[0]}:{quote(password, safe='')}@{host}"))
