"""A transport that answers from recorded pages, for tests."""

from __future__ import annotations

import sys
from dataclasses import dataclass, field
from urllib.parse import parse_qs, urlsplit

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark import cloudpickle

from silvermill.sources.paged import Response

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class ReplayTransport:
    """Answers pages from recorded responses: Parquet under ``path/endpoint/owner=…/repo=…``,
    sorted by page, with the columns page, url, body, next_url, last_url. Bounds and states in
    the request are not applied: what was recorded is what is answered."""

    path: str
    block: int = 100
    _block: dict = field(default_factory=dict, compare=False, repr=False)

    def get(self, owner, repo, endpoint, params, page=None, url=None):
        if url is not None:
            page = int(parse_qs(urlsplit(url).query)["page"][0])
        found = self._pages(endpoint, owner, repo, (page - 1) // self.block).get(page)
        if found is None:
            if page == 1:
                return Response(url="", body="[]")
            raise LookupError(f"no recorded page {page} of {owner}/{repo} {endpoint}")
        return Response(**{k: found[k] for k in ("url", "body", "next_url", "last_url")})

    def _pages(self, *key):
        """The recorded pages of one block; the last block read stays in memory."""
        if key not in self._block:
            endpoint, owner, repo, block = key
            low = block * self.block
            wanted = (ds.field("page") > low) & (ds.field("page") <= low + self.block)
            rows = self._rows(endpoint, owner, repo).filter(wanted).to_table().to_pylist()
            self._block.clear()
            self._block[key] = {row["page"]: row for row in rows}
        return self._block[key]

    def _rows(self, endpoint, owner, repo):
        where = f"{self.path}/{endpoint}".replace("s3a://", "s3://", 1)
        fs, root = pafs.FileSystem.from_uri(where if "://" in where else f"file://{where.removeprefix('file:')}")
        keys = pa.schema([("owner", pa.string()), ("repo", pa.string())])
        recorded = ds.dataset(root, format="parquet", filesystem=fs, partitioning=ds.partitioning(keys, flavor="hive"))
        return recorded.filter((ds.field("owner") == owner) & (ds.field("repo") == repo))
