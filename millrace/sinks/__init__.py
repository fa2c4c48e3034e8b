"""Writers. Every function here runs a Spark job."""
