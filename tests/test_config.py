"""Plan numbers."""

from maskweave.plans.config import Curriculum, eval_rows, numbers, run_label, save_interval


def test_numbers_of_a_large_corpus():
    n = numbers(Curriculum(), 86_500_000)
    assert (n.epoch_steps, n.all_steps, n.chunk) == (10_812_500, 10_812_500, 17_300_000)
    assert n.eval_every == 2_703_125
    assert numbers(Curriculum(epochs=3), 86_500_000)[1:] == (10_812_500, 32_437_500, 901_041)  # Q11
    assert eval_rows(0.05) == 5_000 and eval_rows(0.0) == 1


def test_numbers_of_small_tables():
    c = Curriculum(eval_rows=10)
    assert [numbers(c, n).chunk for n in (1_000, 200, 10_000)] == [200, 40, 2_000]
    assert numbers(c, 30).chunk == c.eval_rows + 1   # never shorter than E + 1
    assert numbers(c, 0)[1:] == (1, 1, 1)


def test_save_interval_and_label():
    assert save_interval(7) == 7 and save_interval(7, trial=True) == 10_000   # Q7
    assert run_label("org/some-model", "nl") == "some-model-nl-full"
    assert run_label("m", "nl", trial=True) == "m-nl-test"
