"""Line sources: text files, Kafka, and lines rendered from the test tables."""
