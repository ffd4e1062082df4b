import sys

from pyspark.sql import SparkSession

from hazardline.command import run

if __name__ == "__main__":
    run(SparkSession.builder.appName("hazardline").getOrCreate(), sys.argv[1:])
