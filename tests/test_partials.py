"""The application table from partials of batches equals the one computed from gold."""

import pytest
from compare import multiset
from pyspark.sql import functions as F

from tweetflow.operators.mentions import mention_app_table
from tweetflow.plans import feed
from tweetflow.schemas import MENTIONS
from tweetflow.sources import files, tables
from tweetflow.sources.tables import read_layer
from tweetflow.streaming import partials, stages


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    messages = feed.messages(spark, sf_dir)
    return [messages.filter(F.pmod(F.crc32("user"), F.lit(3)) == i) for i in range(3)]


def arrive(spark, part, source, layout, scorer):
    part.coalesce(2).write.mode("append").json(source)
    stages.run_stages(spark, source, layout, scorer)


def same(spark, layout):
    whole = multiset(mention_app_table(read_layer(spark, layout, "gold")))
    return multiset(partials.read_mentions(spark, layout)) == whole and bool(whole)


def test_partials_follow_the_table(spark, parts, scorer, new_dir, layout):
    source = new_dir("landing")
    with pytest.raises(stages.UpstreamNotReady):
        partials.start_mentions(spark, layout)
    assert partials.read_mentions(spark, layout).schema == MENTIONS
    assert partials.fold(spark, layout) is None and partials.drop_folded(spark, layout) == 0
    for number, part in enumerate(parts):
        arrive(spark, part, source, layout, scorer)
        partials.start_mentions(spark, layout).awaitTermination()
        assert same(spark, layout)
        folded = partials.fold(spark, layout)
        # The last batch may be run again and is left out.
        assert folded == (number - 1 if number else None) and same(spark, layout)
    assert partials.drop_folded(spark, layout) == 3 and same(spark, layout)
    assert files.child_names(spark, layout.partials) == ["000000000002"]
    tables.reset(spark, layout)
    assert partials.read_mentions(spark, layout).isEmpty()


def test_a_batch_that_is_run_again_replaces_itself(spark, parts, scorer, new_dir, layout):
    source = new_dir("landing")
    for part in parts[:2]:
        arrive(spark, part, source, layout, scorer)
        partials.start_mentions(spark, layout).awaitTermination()
    commits = f"{layout.partials_checkpoint}/commits"
    for _ in range(2):
        files.delete(spark, f"{commits}/1")
        partials.start_mentions(spark, layout).awaitTermination()
        assert same(spark, layout)
    # An attempt that died while it wrote is not read, and replaced.
    files.delete(spark, f"{layout.partials}/000000000001/_SUCCESS")
    files.delete(spark, f"{commits}/1")
    n_rows = partials.read_mentions(spark, layout).agg(F.sum("total")).first()[0]
    assert n_rows < read_layer(spark, layout, "gold").count()
    partials.start_mentions(spark, layout).awaitTermination()
    assert same(spark, layout)


def test_merging_is_the_same_in_any_grouping(spark, parts, scorer):
    from tweetflow.operators.layers import bronze_to_gold

    golds = [bronze_to_gold(part, scorer) for part in parts]
    own = [mention_app_table(gold) for gold in golds]
    left = partials.merge(partials.merge(own[0].union(own[1])).union(own[2]))
    right = partials.merge(own[0].union(partials.merge(own[1].union(own[2]))))
    whole = mention_app_table(golds[0].union(golds[1]).union(golds[2]))
    assert multiset(left) == multiset(right) == multiset(whole)
