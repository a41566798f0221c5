"""Logical schemas of the engine's tables (DDL strings, usable by both APIs)."""

SOURCES = (
    "pos int, type string, repo_url string, reference string, base_url string, space_key string"
)

FILES = "source_dir string, rel_path string, length bigint, content binary"

# The snapshot table: files with the time each was last modified.
SNAPSHOTS = "rel_path string, length bigint, content binary, modified timestamp, source_dir string"

# What the snapshot table holds of each folder, for pruning by time.
SNAPSHOT_FOLDERS = "source_dir string, n_files bigint, first_modified timestamp, last_modified timestamp"

PAGE = (
    "struct<title:string, body:struct<storage:struct<value:string>>, "
    "ancestors:array<struct<title:string>>>"
)

# One landed response of the paged content listing of a wiki space.
CONTENT_BATCHES = f"source_dir string, start int, status int, parsed boolean, results array<{PAGE}>"

# Landed raw responses, before JSON parsing: body is the response text.
LANDED_RESPONSES = "source_dir string, start int, status int, body string"

MANIFEST = "pos int, logical_name string, source_dir string, type string"

ITEMS = "pos int, source_name string, source_dir string, rel_path string, filename string, content binary"

BUCKET_SOURCES = (
    "bucket_id int, external_source_id int, external_source_name string, "
    "updated_by int, updated_datetime string"
)

BUCKET_ITEMS = (
    "bucket_id bigint, external_source_id bigint, external_item_id bigint, url string, "
    "content string, content_hash string, processing_state string, state string, "
    "updated_datetime string"
)

# The stored forms: with the folder (and path) each row was read from, and the partition it lies in.
STORED_SOURCES = f"{BUCKET_SOURCES}, source_dir string, generation bigint"
STORED_ITEMS = f"{BUCKET_ITEMS}, source_dir string, rel_path string, slot int, generation bigint"

# Contents by hash, where items only refer to them.
STORED_CONTENTS = "content_hash string, content string, bucket_id int, generation bigint"

# One row of a commit: the generation a bucket's sources and each slot of its items lie in, and the last ids given.
COMMITS = "bucket_id int, version bigint, sources_at bigint, slots array<bigint>, contents_at array<bigint>, last_source_id bigint, last_item_id bigint"

REPORT = (
    "source_id bigint, source_name string, part bigint, "
    "items array<struct<item_id:bigint,item_name:string>>"
)

REJECTS = "source_dir string, rel_path string, reason string, detail string"
