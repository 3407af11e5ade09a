"""Building blocks made of column expressions; none of them starts a job."""
