"""peakledger: versioned demand series, reconciliation and peak-risk signals as Spark jobs."""
