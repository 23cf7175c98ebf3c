"""Match analytics and outcome prediction on Spark."""
