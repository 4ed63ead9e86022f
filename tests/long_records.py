"""Small long-record tables for the tests of this folder."""


def long_df(spark, rows):
    return spark.createDataFrame(rows, "RecordID long, Parameter string, Time string, Value double")
