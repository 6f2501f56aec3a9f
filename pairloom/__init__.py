"""Build, measure and publish question-answer training collections with Spark."""
