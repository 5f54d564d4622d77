"""cellscope: tower-record analytics written for Spark DataFrames and MLlib."""
