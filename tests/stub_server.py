"""A server of the Arrow-over-HTTP protocol over a folder of Parquet, in a process of its own."""

from __future__ import annotations

import json
import sys
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

import duckdb
import pyarrow as pa

FOLDER = Path(sys.argv[1])
LOG: list[str] = []


def run(sql: str) -> pa.Table:
    con = duckdb.connect()
    for p in FOLDER.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con.sql(sql).to_arrow_table()


class Handler(BaseHTTPRequestHandler):
    def log_message(self, *args):
        pass

    def reply(self, code: int, body: bytes, kind: str) -> None:
        self.send_response(code)
        self.send_header("Content-Type", kind)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        LOG.append("login " + json.dumps(body, sort_keys=True))
        ok = body["password"] == "good"
        self.reply(200 if ok else 401, json.dumps({"accessToken": "token-1"} if ok else {}).encode(), "application/json")

    def do_GET(self):
        url = urllib.parse.urlsplit(self.path)
        args = {k: v[0] for k, v in urllib.parse.parse_qs(url.query).items()}
        if url.path == "/log":
            return self.reply(200, json.dumps(LOG).encode(), "application/json")
        LOG.append(f"{url.path} {args.get('q', '')}")
        if url.path == "/v1/cancel":
            return self.reply(200, b"ok", "text/plain")
        if self.headers.get("Authorization") == "Bearer wrong":
            return self.reply(401, b"no", "text/plain")
        try:
            if url.path == "/v1/plan":
                return self.reply(200, json.dumps(self.plan(args["q"])).encode(), "application/json")
            if args["q"] == "html":
                return self.reply(200, b"<html>", "text/html")
            table = run(args["q"])
        except duckdb.Error as e:
            return self.reply(400, str(e).encode(), "text/plain")
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table, 1000)
        self.reply(200, out.getvalue().to_pybytes(), "application/vnd.apache.arrow.stream")

    def plan(self, sql: str) -> list:
        """Splits by remainder of the row's number; a large split size gives one. Aggregates are planned over their rows."""
        size = int(self.headers.get("x-dd-split-size") or 2)
        n = max(1, min(4, 5 // size))
        head, _, rest = sql.partition(" FROM (")
        inner, close, tail = rest.rpartition(") AS _subq")
        if not close:
            head, inner, tail = "SELECT *", sql, ""
        parts = [f"{head} FROM (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER () AS rn FROM ({inner})) WHERE rn % {n} = {k}) AS _subq{tail}" for k in range(n)]
        return [{"bad": 1}] + [{"endpoints": ["e"], "descriptor": {"statementHandle": {"query": p, "queryId": k, "producerId": "p", "splitSize": size, "queryChecksum": "c"}}} for k, p in enumerate(parts)]


server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
print(server.server_address[1], flush=True)
server.serve_forever()
