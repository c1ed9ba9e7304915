"""rankloom: ranked-list analytics and corpus operators on Spark DataFrames."""
