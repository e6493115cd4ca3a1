"""Entries of what changed the archive: one JSON document each, under the name of the application that wrote it.

Work that is to be told of runs inside `recorded`: its entry is made of what the
work left in its account, when the work ends, however it ends.
"""

from __future__ import annotations

import json
import logging
import secrets
import socket
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from ..schema import APPLICATION, check_name

log = logging.getLogger(__name__)


@dataclass
class Account:
    """What an entry says. A status other than 0: something went wrong."""

    application: str
    comment: str = ""
    details: dict = field(default_factory=dict)
    status: int = 0
    failed: str = "failed: {}"  # the comment where the work ends in an error

    def __post_init__(self) -> None:
        check_name(self.application, APPLICATION)  # it is a folder of the key

    def body(self, at: datetime) -> bytes:
        """Keys sorted, indented, UTC."""
        fields = {"timestamp": at.isoformat(), "application": self.application, "host": socket.gethostname(), "exit_code": self.status, "comment": self.comment, "details": self.details}
        return json.dumps(fields, indent=2, sort_keys=True).encode()


def publish(root: str, account: Account, at: datetime | None = None) -> str:
    """The account as an entry under the archive's root; its key."""
    from pyarrow import fs

    at = at or datetime.now(timezone.utc)
    key = f"_log/{account.application}/{at:%Y/%m/%d/%H%M%S}-{secrets.token_hex(4)}.json"
    store, place = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    path = f"{place}/{key}"
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(f"{path}.part") as out:
        out.write(account.body(at))
    store.move(f"{path}.part", path)
    return key


@contextmanager
def recorded(root: str, account: Account, opening: Account | None = None) -> Iterator[Account]:
    """Publish the account when the work inside ends, with status 1 and its error where it fails; opening: another entry, before.

    A log that cannot be written is a warning of the process's own log: it neither stops the work nor hides how it ended.
    """
    told = [opening] if opening else []
    try:
        tell(root, told)
        yield account
    except BaseException as e:
        account.status, account.comment = account.status or 1, account.failed.format(e)
        raise
    finally:
        tell(root, [account])


def tell(root: str, accounts: list[Account]) -> None:
    for account in accounts:
        try:
            publish(root, account)
        except Exception:
            log.warning("no audit entry of %s could be written: %s", account.application, account.comment, exc_info=True)
