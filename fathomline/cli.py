"""Command line: `python -m fathomline.cli ingest|search ...`."""

from __future__ import annotations

import argparse

from fathomline.config import ChunkingConfig, IndexConfig, batch_sizes
from fathomline.session import session, shipped


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="fathomline")
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("ingest", help="a folder of files to chunk and rejection tables")
    p.add_argument("corpus")
    p.add_argument("output")
    p.add_argument("--topics", default="{}", help='JSON such as {"folder": 1}')
    p.add_argument("--strategy", default="paragraph_overlap")
    p = commands.add_parser("encode", help="chunks to embeddings, only those that the output lacks")
    p.add_argument("chunks")
    p.add_argument("output")
    p.add_argument("--encoders", default="hashed-384")
    p.add_argument("--exclude", default="", help="encoders to leave out")
    p.add_argument("--batch-sizes", default="", help="such as hashed-384=64,e5-multilingual-base=8")
    p = commands.add_parser("deliver", help="chunks and one encoder's embeddings to an index with metadata")
    p.add_argument("chunks")
    p.add_argument("embeddings")
    p.add_argument("encoder")
    p.add_argument("output")
    p.add_argument("--partial", action="store_true", help="leave out chunks without a vector")
    p = commands.add_parser("search", help="queries to documents and fragments")
    p.add_argument("queries")
    p.add_argument("embeddings")
    p.add_argument("chunks")
    p.add_argument("output")
    p.add_argument("--k-search", type=int, default=50)
    p.add_argument("--k0", type=int, default=60)
    p.add_argument("--theta", type=float, default=0.0)
    p.add_argument("--doc-agg", default="max")
    p.add_argument("--index", default="auto", help="flat_ip, ivf_flat, hnsw or auto")
    args = parser.parse_args(argv)
    spark = shipped(session())
    if args.command == "ingest":
        from fathomline.plans.ingest import ingest
        from fathomline.sources.corpus import documents, topic_map

        accepted, rejected = ingest(documents(spark, args.corpus, topic_map(args.topics)).filter("error is null"), ChunkingConfig(strategy=args.strategy))
        accepted.write.mode("overwrite").parquet(f"{args.output}/chunks")
        rejected.write.mode("overwrite").parquet(f"{args.output}/rejected")
    elif args.command == "encode":
        from fathomline.operators.encoding import encode_pending
        from fathomline.operators.store import Table

        split = lambda x: [n for n in (p.strip() for p in x.split(",")) if n]
        table = Table(spark, args.output)
        cache = table.read() if table.exists() else spark.createDataFrame([], "chunk_id string, encoder_name string, hash_texto string")
        found = encode_pending(spark.read.parquet(args.chunks), cache, split(args.encoders), tuple(split(args.exclude)), batch_sizes(args.batch_sizes))
        table.upsert(found, ["chunk_id", "encoder_name"])
    elif args.command == "deliver":
        from fathomline.operators.export import delivery
        from fathomline.operators.store import find_by_encoder

        print(delivery(spark.read.parquet(args.chunks), find_by_encoder(spark.read.parquet(args.embeddings), args.encoder), args.output, partial=args.partial))
    else:
        from fathomline.operators.export import results_jsonl
        from fathomline.plans.retrieval import results, retrieve
        from fathomline.sources.queries import load

        docs, fragments = retrieve(load(spark, args.queries), spark.read.parquet(args.embeddings), spark.read.parquet(args.chunks), theta=args.theta, k_search=args.k_search, doc_agg=args.doc_agg, k0=args.k0, index=IndexConfig(args.index))
        print(results_jsonl(results(docs, fragments), args.output))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
