"""The jobs, to be submitted: bronze, silver, gold, publish.

    spark-submit --py-files wardstream.zip wardstream/__main__.py bronze \\
        --servers host:9093 --topic encounters --path .../bronze --checkpoint .../bronze_cp
"""

import argparse
import os

from pyspark.sql import SparkSession

from wardstream import schemas
from wardstream.plans.gold import Gold
from wardstream.plans.parted import PartedGold
from wardstream.plans.publish import publish, publish_parts
from wardstream.sources.broker import broker_stream
from wardstream.sources.tables import table_stream
from wardstream.streaming import ingest
from wardstream.streaming.gold import start_gold


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="wardstream")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, stream: bool = True) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        p.add_argument("--path", required=True, help="folder of the table(s) written")
        if stream:
            p.add_argument("--checkpoint", required=name != "gold")
            p.add_argument("--available-now", action="store_true", help="drain and stop")
            p.add_argument("--trigger", help="processing interval, as '1 minute'")
        return p

    bronze = job("bronze")
    bronze.add_argument("--servers", required=True)
    bronze.add_argument("--topic", required=True)
    bronze.add_argument("--username", help="SASL user; the password is read from the environment")
    bronze.add_argument("--password-env", default="BROKER_PASSWORD")
    bronze.add_argument("--starting-offsets", default="latest")
    bronze.add_argument("--tolerate-data-loss", action="store_true")

    silver = job("silver")
    silver.add_argument("--bronze", required=True)
    silver.add_argument("--quarantine", help="folder for the text of unusable rows")

    gold = job("gold")
    gold.add_argument("--silver", required=True)
    gold.add_argument("--stream", action="store_true", help="follow silver instead of one refresh")
    gold.add_argument("--as-of", help="clock of the refresh; the current time by default")
    gold.add_argument("--hashed-keys", action="store_true", help="hash patient keys")
    gold.add_argument("--by-parts", action="store_true", help="rewrite only the parts that new rows touch")

    for p in (bronze, silver, gold):
        p.add_argument("--format", default="parquet", help="table format of bronze and silver")
    bronze.add_argument("--login-module", help="login class where the platform relocates it")

    tables = job("publish", stream=False)
    tables.add_argument("--database", required=True)
    tables.add_argument("--by-parts", action="store_true", help="the gold tables are kept by parts")
    return parser


def _parted(spark: SparkSession, args: argparse.Namespace, **kw) -> PartedGold:
    return PartedGold(spark, args.path, parts=1, key_block=None if args.hashed_keys else 10_000, **kw)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"wardstream-{args.job}").getOrCreate()
    if args.job == "publish":
        if args.by_parts:
            publish_parts(PartedGold(spark, args.path), args.database)
        else:
            publish(Gold(spark, args.path), args.database)
        return
    timing = {"available_now": args.available_now, "trigger": args.trigger}
    running = []
    if args.job == "bronze":
        wire = broker_stream(
            spark,
            servers=args.servers,
            topic=args.topic,
            username=args.username,
            password=os.environ.get(args.password_env),
            starting_offsets=args.starting_offsets,
            fail_on_data_loss=not args.tolerate_data_loss,
            **({"login_module": args.login_module} if args.login_module else {}),
        )
        running.append(
            ingest.start_bronze(wire, args.path, args.checkpoint, fmt=args.format, **timing)
        )
    elif args.job == "silver":
        timing["fmt"] = args.format
        bronze = table_stream(spark, args.bronze, schemas.BRONZE_BROKER, args.format)
        running.append(
            ingest.start_silver(bronze, args.path, args.checkpoint, dq="dq", **timing)
        )
        if args.quarantine:
            checkpoint = f"{args.checkpoint.rstrip('/')}_quarantine"
            running.append(
                ingest.start_quarantine(bronze, args.quarantine, checkpoint, **timing)
            )
    elif args.stream:
        if not args.checkpoint:
            raise SystemExit("--stream needs --checkpoint")
        gold = Gold(spark, args.path, dense_keys=not args.hashed_keys)
        if args.by_parts:
            # The stream's state holds the latest encounters.
            gold = _parted(spark, args, keeps_latest=False)
        silver = table_stream(spark, args.silver, schemas.SILVER, args.format)
        running.append(start_gold(silver, gold, args.checkpoint, args.as_of, **timing))
    elif args.by_parts:
        silver = spark.read.format(args.format).schema(schemas.SILVER).load(args.silver)
        written = _parted(spark, args).refresh(silver, args.as_of)
        print(f"parts={len(written)}")
    else:
        gold = Gold(spark, args.path, dense_keys=not args.hashed_keys)
        silver = spark.read.format(args.format).schema(schemas.SILVER).load(args.silver)
        written = gold.refresh(silver, args.as_of)
        gold.check_keys()
        print(" ".join(f"{table}={rows}" for table, rows in written.items()))
    for query in running:
        query.awaitTermination()


if __name__ == "__main__":
    main()
