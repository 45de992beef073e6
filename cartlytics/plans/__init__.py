"""Physical-plan helpers: the distributed global ranking used by the
unpartitioned window queries, and materialisation of reused inputs."""
