"""The same results in DuckDB SQL, written independently of the Spark plans.

Windows, long form and regular expressions are used freely here; the Spark
side has to reach the same rows another way.
"""

from __future__ import annotations

from thumbwheel.functions.text import STRIP_CHARS
from workload.inputs import MODELS

_STRIP = "".join(f"chr({ord(c)})||" for c in STRIP_CHARS)[:-2]
_BASE, _SFT, _KTO = MODELS

PAIRS = """
s as (select *, lead(role) over (partition by conv_id order by turn) nr,
             lead(text) over (partition by conv_id order by turn) nt from conversations),
p as (select conv_id, turn, text prompt, nt reply from s where role = 'user' and nr = 'assistant'),
q as (select *, lead(reply) over (partition by conv_id order by turn) rej from p),
pairs as (select conv_id * 1000000 + turn example_id,
                 case when conv_id % 10 = 0 then 'test' else 'train' end split,
                 'p' || conv_id prompt_id, prompt, chr(10) || ' ' || reply || ' ' || chr(9) chosen, rej rejected,
                 cast((length(reply) + 4) % 21 as double) / 4 score_chosen,
                 cast(length(rej) % 21 as double) / 4 score_rejected
          from q where rej is not null),
unpaired as (select example_id, 0 branch, split, prompt, chosen reply, 1 label from pairs
             union all
             select example_id, 1 branch, split, prompt, rejected reply, 0 label from pairs)
"""

VERDICTS = """
raws as (select doc_id example_id, length(text) turn, chr(10) || ' ' || text || chr(10) ||
           case doc_id % 9 when 0 then ' The answer is [[A]]' when 1 then 'The answer is [[B]] ' || chr(9)
                when 2 then 'The answer is [[C]]' when 3 then 'I prefer [[A]]. The answer is [[A]]'
                when 4 then 'no verdict' when 5 then 'The answer is A? no. The answer is [[B]]'
                when 6 then 'The answer is ' || chr(10) || chr(9) || ' [[A]] ' || chr(10)
                when 7 then 'short. The answer is [[B]] and more [[A]]' else 'The answer is [[D]]' end
           || chr(10) raw from documents),
cuts as (select *, case when regexp_matches(raw, '\\[\\[[ABC]\\]\\]')
                        then regexp_extract(raw, '(?s)^(.*?\\[\\[[ABC]\\]\\])', 1) else raw end cut from raws),
parsed as (select *,
    regexp_extract(trim(list_last(string_split(raw, 'The answer is')), {strip}), '^\\[\\[(A|B|C)\\]\\]', 1) v0,
    regexp_extract(trim(list_last(string_split(cut, 'The answer is')), {strip}), '^\\[\\[(A|B|C)\\]\\]', 1) v1
  from cuts),
judged as (select example_id,
    case turn % 3 when 0 then '{base}' when 1 then '{sft}' else '{kto}' end model_a,
    case (turn + 1) % 3 when 0 then '{base}' when 1 then '{sft}' else '{kto}' end model_b,
    case v0 when '' then 'error' else v0 end verdict_uncut,
    case v1 when '' then 'error' else v1 end verdict,
    case v1 when 'A' then 0 when 'B' then 1 end winner from parsed)
""".format(strip=_STRIP, base=_BASE, sft=_SFT, kto=_KTO)

ROLLOUTS = """
lines as (select l_orderkey, l_linenumber, cast(sum(l_partkey) as bigint) a, cast(sum(l_suppkey) as bigint) b
          from lineitem group by all),
ro as (select l_orderkey % 16 + 1 update_id, l_orderkey prompt_id, cast(l_linenumber - 1 as bigint) sample_idx,
              l_orderkey * 8 + l_linenumber rollout_id, a, b, 4 + a % 5 n_tokens,
              cast((a % 9) - 4 as double) / 4 logit0, cast((b % 7) - 3 as double) / 4 logit1,
              l_orderkey, l_linenumber from lines),
tk as (select rollout_id, i, 1 + (a + 7 * i) % 11 token,
              -cast((b + 3 * i) % 17 + 1 as double) / 16 logp,
              -cast((b + 5 * i) % 13 + 1 as double) / 16 ref_logp, b
       from (select *, unnest(range(n_tokens)) i from ro)),
st as (select rollout_id, min(i) filter (token = 1) stop_at from tk group by 1),
tt as (select tk.*, case when i > stop_at then 0 else token end truncated, stop_at from tk join st using (rollout_id)),
sl as (select rollout_id, cast(coalesce(min(i) filter (truncated = 0) - 1, max(i)) as integer) sequence_length,
              bool_or(truncated = 1) has_eos from tt group by 1),
tm as (select tt.rollout_id, i, b, token, truncated, i > sequence_length masked,
              case when i > sequence_length then 1.0::double else logp end logp,
              case when i > sequence_length then 1.0::double else ref_logp end ref_logp
       from tt join sl using (rollout_id)),
ag as (select rollout_id, sum(logp) logp_sum, sum(ref_logp) ref_logp_sum,
              sum(logp - ref_logp) kl, cast(count(*) filter (masked) as integer) n_masked,
              count(*) filter (token = 1) num_eos from tm group by 1),
ep as (select *, case when masked then 1.0::double
                      else -cast((b + ppo_epoch + (11 + 2 * ppo_epoch) * i) % 19 + 1 as double) / 16 end new_logp
       from tm, (select unnest([0, 1]) ppo_epoch)),
eg as (select rollout_id, ppo_epoch, sum(new_logp) new_logp_sum, sum(exp(new_logp - logp)) token_ratio_sum,
              sum(cast((b + 3 * ppo_epoch + 13 * i) % 10 + 1 as double) / 8) entropy_sum from ep group by 1, 2),
rw as (select ro.*, ag.* exclude (rollout_id), sl.sequence_length, sl.has_eos,
              -0.0625::double * kl non_score_reward,
              case when logit1 > logit0 then 1.0::double else 0.0::double end reward_score,
              case when logit1 > logit0 then 1.0::double else 0.0::double end - 0.0625::double * kl rlhf_reward
       from ro join ag using (rollout_id) join sl using (rollout_id)),
adv as (select *, rlhf_reward - (sum(rlhf_reward) over g - rlhf_reward) / nullif(count(*) over g - 1, 0) advantage
        from rw window g as (partition by update_id, prompt_id, sample_idx // 2)),
pol as (select *, exp(new_logp_sum - logp_sum) ratio,
               -advantage * exp(new_logp_sum - logp_sum) loss1,
               -advantage * least(greatest(exp(new_logp_sum - logp_sum), 0.8::double), 1.2::double) loss2,
               power(new_logp_sum - logp_sum, 2) sq, (l_orderkey // 16 + ppo_epoch) % 4 minibatch,
               (l_linenumber - 1 + ppo_epoch) % 2 microbatch from adv join eg using (rollout_id)),
slots as (select update_id, ppo_epoch, minibatch, microbatch, avg(case when loss1 > loss2 then loss1 else loss2 end) policy_loss,
                 avg(case when loss2 > loss1 then 1.0::double when loss2 <= loss1 then 0.0::double end) clipfrac,
                 0.5 * avg(sq) approxkl, sum(entropy_sum) / sum(n_tokens) entropy,
                 sum(token_ratio_sum) / sum(n_tokens) ratio from pol group by all)
"""

# CRC-32 of every distinct word's bytes, from the table of its reflected polynomial.
WORDS = r"""
crc_bits as (select n, n c, 0 k from range(256) r(n)
             union all
             select n, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1
             from crc_bits where k < 8),
crc_table as (select list(c order by n) t from crc_bits where k = 8),
wl as (select doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda x: x <> '') ws from documents),
wb as (select w, regexp_extract_all(hex(encode(w)), '..') h from (select distinct unnest(ws) w from wl)),
crc as (select w, xor(list_reduce(list_prepend(4294967295, list_transform(h, lambda x: cast('0x' || x as bigint))),
                                  lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) crc
        from wb, crc_table),
ws as (select doc_id, unnest(ws) w, generate_subscripts(ws, 1) - 1 i from wl),
ids as (select doc_id, i, cast(crc % 2147483645 + 2 as integer) id from ws join crc using (w)),
nt as (select doc_id, count(*) n from ws group by 1)
"""

PACK = """
sz as (select doc_id, n + 1 n from nt),
run as (select doc_id, n, cast(sum(n) over (order by doc_id) - n as bigint) st,
               cast(sum(n) over () as bigint) // 2048 full_blocks from sz)
"""

COMPLETIONS = f"""
comp as (select page_id ordinal, '{_BASE}' model, html text from pages
         union all select doc_id, '{_SFT}', text from documents
         union all select item_id, '{_KTO}', text from benchmark),
prompts as (select doc_id ordinal, ' Describe ' || source || ':' || chr(10) || text || chr(9) prompt from documents),
asked as (select a.ordinal, prompt, a.text answer_a, b.text answer_b
          from comp a join comp b using (ordinal) join prompts using (ordinal)
          where a.model = '{_BASE}' and b.model = '{_SFT}')
"""

LOGITS = """
lg as (select vec_id, unnest(embedding) x, generate_subscripts(embedding, 1) - 1 d from embeddings),
lt as (select vec_id rollout_id, d // 16 pos, d % 16 token, cast(x as double) x,
              cast(x as double) / (0.7 + 1e-7)::double xt, (vec_id + d // 16) % 16 chosen from lg),
mx as (select *, max(x) over (partition by rollout_id, pos) m, max(xt) over (partition by rollout_id, pos) mt from lt),
lse as (select rollout_id, pos, max(m) + ln(sum(exp(x - m))) lz, max(mt) + ln(sum(exp(xt - mt))) lzt,
               max(x) filter (token = chosen) px, max(xt) filter (token = chosen) pxt,
               sum(exp(xt - mt) * xt) / sum(exp(xt - mt)) ex from mx group by 1, 2)
"""

JUDGED_TEXT = """
case when (length(answer_a) + length(answer_b)) % 11 = 0 then 'cannot say'
     else 'Compared lengths. The answer is [[' || case when length(answer_a) > length(answer_b) then 'A'
          when length(answer_b) > length(answer_a) then 'B' else 'C' end || ']] indeed' end
"""
JUDGED_WINNER = """
case when (length(answer_a) + length(answer_b)) % 11 = 0 then null
     when length(answer_a) > length(answer_b) then 0 when length(answer_b) > length(answer_a) then 1 end
"""


def _with(*parts: str) -> str:
    return "with recursive " + ",".join(parts) + " "


def _dialogue(reply: str) -> str:
    return f"'user=' || prompt || '|assistant=' || {reply}"


def build() -> dict[str, str]:
    sql: dict[str, str] = {}

    # sources and sinks
    pair_cols = "example_id, split, prompt_id, prompt, score_chosen, score_rejected"
    sql["load_split"] = _with(PAIRS) + f"select {pair_cols} from pairs where split = 'train'"
    sql["split_union"] = """select doc_id example_id, text, 'train' split from documents
        union all select page_id, html, 'test' from pages"""
    sql["source_adapter"] = _with(PAIRS) + f"""
        select example_id ordinal, prompt, trim(chosen, {_STRIP}) reference, 'chosen_messages' layout from pairs
        union all select doc_id, source, text, 'plain' from documents"""
    sql["assemble_messages"] = """select conv_id, turn // 8 segment, count(*) n_messages,
        string_agg(role || '=' || text, '|' order by turn) rendered from conversations group by 1, 2"""
    sql["read_completions"] = f"select doc_id ordinal, '{_BASE}' model, text from documents"
    sql["read_completions_unnumbered"] = f"""select row_number() over (order by doc_id) - 1 ordinal,
        '{_BASE}' model, text from documents"""
    sql["write_unpaired"] = _with(PAIRS) + f"""
        select example_id, branch, split, label, {_dialogue('reply')} completion from unpaired"""
    sql["write_completions"] = _with(COMPLETIONS) + """
        select ordinal, replace(model, '/', '_') model, model model_name, text from comp"""
    rate = """count(winner) decided,
        round(100.0 * sum(winner) / nullif(count(winner), 0), 6)::double rate_b,
        round(100.0 - 100.0 * sum(winner) / nullif(count(winner), 0), 6)::double rate_a"""
    sql["write_win_rate"] = _with(VERDICTS) + f"""
        select replace(model_a, '/', '_') model_a, replace(model_b, '/', '_') model_b, {rate}
        from judged group by model_a, model_b"""
    sql["write_metrics"] = """with f as (select lang, quality label,
            case when length(text) % 3 > length(text) % 5 then 1 else 0 end pred
            from documents join labels using (doc_id))
        select 'pointwise' run, lang, 'accuracy' metric,
               round(avg(case when pred = label then 1.0 else 0.0 end), 6)::double as "value" from f group by lang
        union all select 'pointwise', lang, 'eval_samples', count(*)::double from f group by lang"""

    # projections
    sql["drop_columns"] = _with(PAIRS) + f"""select example_id, split, prompt,
        {_dialogue('chosen')} chosen, {_dialogue('rejected')} rejected from pairs"""
    sql["prompt_to_chat"] = _with(PAIRS) + "select example_id, 'user=' || prompt prompt from pairs"
    sql["pairs_to_unpaired"] = _with(PAIRS) + f"""
        select example_id, branch, split, prompt, {_dialogue('reply')} completion, label from unpaired"""
    sql["keep_assistant"] = """select conv_id, turn // 8 segment, count(*) filter (role = 'assistant') n_messages,
        coalesce(string_agg(role || '=' || text, '|' order by turn) filter (role = 'assistant'), '') rendered
        from conversations group by 1, 2"""
    sql["assistant_turns"] = """select conv_id, turn, role || '=' || text rendered
        from conversations where role = 'assistant'"""
    sql["build_kto_dataset"] = _with(PAIRS) + """
        select example_id, branch, split, 'user=' || prompt prompt, 'assistant=' || reply completion,
               1::bigint n_messages, label = 1 as label from unpaired"""
    sql["build_unpaired_dataset"] = _with(PAIRS) + f"""
        select example_id, branch, split, 'user=' || prompt prompt, {_dialogue('reply')} completion,
               2::bigint n_messages, label from unpaired"""
    sql["reference_text"] = _with(PAIRS) + f"select example_id, trim(chosen, {_STRIP}) reference from pairs"
    sql["render_chat"] = _with(PAIRS) + """
        select example_id, '<|im_start|>user' || chr(10) || prompt || '<|im_end|>' || chr(10)
            || '<|im_start|>assistant' || chr(10) || chosen || '<|im_end|>' || chr(10) as text from pairs"""
    sql["render_simple_chat"] = _with(PAIRS) + """
        select example_id, 'User: ' || prompt || chr(10) || chr(10)
            || 'Assistant: ' || rejected || chr(10) || chr(10) as text from pairs"""
    sql["label_names"] = """select doc_id, case quality when 0 then 'BAD' when 1 then 'GOOD' end label_name,
        quality label_id from documents join labels using (doc_id)"""
    sql["repeat_prompts"] = _with(COMPLETIONS) + """
        select ordinal, prompt, 0 sample_idx from prompts union all select ordinal, prompt, 1 from prompts"""

    # filters
    sql["head_examples"] = _with(COMPLETIONS) + "select * from prompts order by ordinal limit 150"
    sql["eval_sample"] = _with(COMPLETIONS) + "select * from prompts order by ordinal limit 100"
    sql["max_length_filter"] = _with(WORDS) + "select doc_id, n n_tokens from nt where n <= 2048"
    sql["drop_error_verdicts"] = _with(VERDICTS) + """
        select example_id, verdict, winner from judged where winner is not null"""
    cut = """position // 64 minibatch, (position % 64) // 8 microbatch"""
    sql["shuffle_batches"] = f"""with e as (select o_orderkey, unnest([0, 1]) ppo_epoch from orders),
        o as (select *, row_number() over (partition by ppo_epoch
                order by md5('7:' || ppo_epoch || ':' || o_orderkey), o_orderkey) - 1 as position from e)
        select o_orderkey, ppo_epoch, position, {cut} from o"""
    sql["shuffle_within_updates"] = f"""with r as (select distinct l_orderkey % 16 + 1 update_id,
                l_orderkey * 8 + l_linenumber rollout_id from lineitem),
        o as (select *, 0 ppo_epoch, row_number() over (partition by update_id
                order by md5('7:0:' || rollout_id), rollout_id) - 1 as position from r)
        select update_id, rollout_id, ppo_epoch, position, {cut} from o"""

    # tokens
    sql["tokenize"] = _with(WORDS) + """
        select doc_id, count(*) n_tokens, cast(sum(id) as bigint) id_sum,
               arg_min(id, i) first_id, arg_max(id, i) last_id from ids group by 1"""
    sql["reward_training_rows"] = _with(PAIRS) + r"""
        , t as (select *, '<|im_start|>user' || chr(10) || prompt || '<|im_end|>' || chr(10) || '<|im_start|>assistant'
                          || chr(10) || reply || '<|im_end|>' || chr(10) as text from unpaired),
        n as (select example_id, branch, split, label,
                     len(regexp_extract_all(text, '[^ \t\n\r\f\v]+')) n_tokens from t)
        select * from n where n_tokens <= 2048"""
    sql["pack_sequences"] = _with(WORDS, PACK) + """
        , spans as (select *, unnest(generate_series(st // 2048, (st + n - 1) // 2048)) block from run)
        select block, doc_id, greatest(block * 2048 - st, 0) from_token,
               least((block + 1) * 2048 - st, n) to_token from spans where block < full_blocks"""
    sql["packed_block_tokens"] = _with(WORDS, PACK) + """
        , stream as (select st + i as pos, id, full_blocks from ids join run using (doc_id)
                     union all select st + n - 1, 1, full_blocks from run)
        select pos // 2048 block, count(*) n_tokens, cast(sum(id) as bigint) id_sum,
               arg_min(id, pos) first_id, arg_max(id, pos) last_id
        from stream where pos // 2048 < full_blocks group by 1"""
    sql["truncate_prompt"] = _with(WORDS) + """
        , l as (select doc_id, n, list(id order by i) t from ids join nt using (doc_id) group by 1, 2),
        c as (select d.doc_id, coalesce(p.n, 0) pn, p.t pt, a.t answer, least(pn, 512) np,
                     least(coalesce(a.n, 0), 2048 - np) nc
              from documents d left join l p using (doc_id) left join l a on a.doc_id = d.doc_id + 1)
        select doc_id, np prompt_tokens, nc completion_tokens, pt[pn - np + 1] prompt_first, pt[pn] prompt_last,
               answer[1] completion_first, answer[nc] completion_last from c"""
    sql["tokenize_plugin"] = _with(WORDS) + """
        select doc_id, count(*) n_tokens, cast(sum(id) as bigint) id_sum from ids group by 1"""
    sql["rloo_prompts"] = _with(WORDS) + """
        , l as (select doc_id, n, sum(id) s, arg_max(id, i) z from ids join nt using (doc_id) group by 1, 2),
        b as (select *, max(n) over (partition by batch_id) width
              from (select *, (row_number() over (order by doc_id) - 1) // 32 batch_id from l))
        select doc_id ordinal, batch_id, unnest([0, 1]) sample_idx, width, n n_real, cast(s as bigint) id_sum,
               z last_id from b"""
    words = r"len(regexp_extract_all({0}, '[^ \t\n\r\f\v]+'))"
    chat = "'<|im_start|>' || {0} || chr(10) || {1} || '<|im_end|>' || chr(10)"
    sql["sft_packing"] = f"""
        with t as (select conv_id, turn, {words.format(chat.format('role', 'text'))}
                          + (turn = max(turn) over (partition by conv_id))::bigint n from conversations),
        r as (select *, cast(sum(n) over (order by conv_id, turn) - n as bigint) st,
                     cast(sum(n) over () as bigint) // 2048 full_blocks from t),
        s as (select *, unnest(generate_series(st // 2048, (st + n - 1) // 2048)) block from r)
        select block, conv_id, turn, greatest(block * 2048 - st, 0) from_token,
               least((block + 1) * 2048 - st, n) to_token from s where block < full_blocks"""
    sql["kto_training_rows"] = _with(PAIRS) + f"""
        , n as (select example_id, branch, split, label = 1 as label,
                       {words.format(chat.format("'user'", 'prompt'))} np,
                       {words.format(chat.format("'assistant'", 'reply'))} nc from unpaired)
        select example_id, branch, split, label, least(np, 12) prompt_tokens,
               least(nc, 40 - least(np, 12)) completion_tokens from n"""
    padded = _with(WORDS) + """
        , l as (select doc_id, n, sum(id) s, arg_min(id, i) f, arg_max(id, i) z
                from ids join nt using (doc_id) group by 1, 2),
        b as (select *, max(n) over (partition by batch_id) width
              from (select *, (row_number() over (order by doc_id) - 1) // 32 batch_id from l))
        select doc_id, batch_id, '{side}' side, width, n n_real, cast(s as bigint) id_sum,
               {first} first_id, {last} last_id from b"""
    zero_if_short = lambda v: f"case when n < width then 0 else {v} end"
    sql["pad_batch"] = padded.format(side="right", first="f", last=zero_if_short("z"))
    sql["pad_batch_left"] = padded.format(side="left", first=zero_if_short("f"), last="z")
    sql["truncate_at_stop"] = _with(ROLLOUTS) + """
        select rollout_id, string_agg(truncated::varchar, ',' order by i) truncated from tt group by 1"""
    sql["sequence_length"] = _with(ROLLOUTS) + "select rollout_id, sequence_length from sl"
    sql["padding_mask"] = _with(ROLLOUTS) + """
        select rollout_id, n_masked, logp_sum, ref_logp_sum from ag"""
    sql["contains_eos"] = _with(ROLLOUTS) + "select rollout_id, has_eos from sl"
    sql["num_eos"] = _with(ROLLOUTS) + """
        select update_id, cast(sum(num_eos) as bigint) num_eos_tokens from rw group by 1"""
    sql["log_softmax_gather"] = _with(LOGITS) + "select rollout_id, pos, round(pxt - lzt, 6) logp from lse"
    sql["log_softmax_generation"] = _with(LOGITS) + "select rollout_id, pos, round(px - lz, 6) logp from lse"
    sql["log_softmax_arrays"] = _with(LOGITS) + """
        select rollout_id, pos, round(pxt - lzt, 6) logp, round(lzt - ex, 6) entropy from lse"""
    sql["token_entropy"] = _with(LOGITS) + "select rollout_id, pos, round(lzt - ex, 6) entropy from lse"

    # joins
    sql["pair_reference_candidate"] = """select doc_id ordinal, d.text answer_a, p.html answer_b
        from documents d join pages p on doc_id = page_id"""
    sql["pair_unmatched"] = """select count(*) filter (doc_id is not null and page_id is not null) matched,
        count(*) filter (page_id is null) left_only, count(*) filter (doc_id is null) right_only
        from documents full join pages on doc_id = page_id"""
    sql["pair_two_models"] = _with(COMPLETIONS) + f"""
        select a.ordinal, a.text answer_a, b.text answer_b from comp a join comp b using (ordinal)
        where a.model = '{_BASE}' and b.model = '{_SFT}'"""
    sql["attach_prompts"] = _with(COMPLETIONS) + "select ordinal, prompt, answer_a, answer_b from asked"
    sql["all_pairs_tournament"] = _with(COMPLETIONS) + """
        select a.ordinal, a.model model_a, b.model model_b, a.text answer_a, b.text answer_b
        from comp a join comp b on a.ordinal = b.ordinal and a.model < b.model"""

    # aggregations
    strided = """
        v as (select vec_id, label, unnest(embedding)::double x, generate_subscripts(embedding, 1) - 1 i from embeddings),
        l as (select vec_id, label, i % {n} j, sum(x order by i) s from v group by 1, 2, 3)"""
    sql["accuracy"] = "with" + strided.format(n=10) + """,
        b as (select vec_id, label, max(s) m from l group by 1, 2),
        p as (select vec_id, b.label, min(j) guess from l join b using (vec_id) where s = m group by 1, 2)
        select round(avg(case when guess = label then 1.0 else 0.0 end), 6)::double accuracy, count(*) n from p"""
    sql["win_rate_vs_reference"] = _with(VERDICTS) + """
        select model_a model, count(winner) decided, cast(sum(winner) as bigint) wins,
               round(avg(winner), 6) win_rate, round(100 * avg(winner), 6) win_rate_percent
        from judged group by 1"""
    sql["win_rate_1v1"] = _with(VERDICTS) + f"""
        select model_a, model_b, {rate} from judged group by 1, 2"""
    sql["verdict_distribution"] = _with(VERDICTS) + """
        select count(*) filter (verdict = 'A') n_a, count(*) filter (verdict = 'B') n_b,
               count(*) filter (verdict = 'C') n_tie, count(*) filter (verdict = 'error') n_error,
               count(*) n, round(avg(case verdict when 'error' then 1.0 else 0.0 end), 6)::double error_rate
        from judged"""
    sql["eval_samples"] = _with(PAIRS) + "select split, count(*) eval_samples from unpaired group by 1"
    sql["label_balance"] = """select lang, quality as label, count(*) n
        from documents join labels using (doc_id) group by 1, 2"""
    sql["pairwise_reward_eval"] = _with(PAIRS) + """
        , m as (select split, score_chosen - score_rejected d from pairs)
        select split, count(*) n, round(avg(case when d > 0 then 1.0 else 0.0 end), 6)::double accuracy,
               round(avg(d), 6) mean_margin, round(avg(-ln(1 / (1 + exp(-d)))), 6) loss from m group by 1"""
    sql["pointwise_reward_eval"] = "with" + strided.format(n=2) + """,
        e as (select vec_id, label % 2 y, sum(s) filter (j = 0) x0, sum(s) filter (j = 1) x1 from l group by 1, 2),
        c as (select *, case when x1 > x0 then 1 else 0 end pred,
              ln(exp(x0) + exp(x1)) - case y when 1 then x1 else x0 end ce from e)
        select count(*) n, round(avg(ce), 6) cross_entropy,
               round(avg(case when pred = y then 1.0 else 0.0 end), 6)::double accuracy,
               count(*) filter (pred = 1 and y = 1) true_good, count(*) filter (pred = 1 and y = 0) false_good,
               count(*) filter (pred = 0 and y = 0) true_bad, count(*) filter (pred = 0 and y = 1) false_bad
        from c"""
    points = _with(ROLLOUTS) + """
        , km as (select update_id, prompt_id, rollout_id, coalesce(lag(rollout_id) over g,
                        max(rollout_id) over (partition by update_id)) other
                 from ro window g as (partition by update_id order by rollout_id)),
        kp as (select update_id, km.rollout_id,
                      sum(-cast((prompt_id + token * 7 + i) % 17 + 1 as double) / 16) lp,
                      sum(-cast((prompt_id + token * 5 + i) % 13 + 1 as double) / 16) rp
               from km join tk on tk.rollout_id = other group by 1, 2),
        kz as (select update_id, count(*) n, greatest(avg(lp - rp), 0::double) z from kp group by 1)"""
    sql["kto_mismatched_pairs"] = points + """
        select update_id, km.rollout_id, other, km.prompt_id, n_tokens from km join ro using (update_id)
        where ro.rollout_id = other"""
    sql["kto_reference_point"] = points + "select update_id, n, round(z, 6) z from kz"
    sql["kto_objective"] = points + """
        , k as (select update_id, logp_sum - ref_logp_sum r, reward_score lab, z from rw join kz using (update_id))
        select update_id, count(*) n,
               round(avg(case when lab = 1 then 1 - 1 / (1 + exp(-0.1::double * (r - z)))
                              else 1 - 1 / (1 + exp(-0.1::double * (z - r))) end), 6) loss,
               avg(r) filter (lab = 1) log_ratio_up, avg(r) filter (lab = 0) log_ratio_down
        from k group by 1"""

    # rollout mathematics
    ro = _with(ROLLOUTS)
    sql["sequence_kl"] = ro + "select rollout_id, kl from rw"
    sql["non_score_reward"] = ro + "select rollout_id, non_score_reward from rw"
    sql["eos_penalty"] = ro + """select rollout_id,
        case when has_eos then logit0 else logit0 - 1 end logit0,
        case when has_eos then logit1 else logit1 - 1 end logit1 from rw"""
    sql["thumbs_score"] = ro + "select rollout_id, reward_score thumbs from rw"
    sql["rlhf_reward"] = ro + "select rollout_id, reward_score, rlhf_reward from rw"
    sql["rlhf_reward_after_argmax"] = ro + """select rollout_id,
        reward_score - case when has_eos then 0 else 1 end reward_score,
        rlhf_reward - case when has_eos then 0 else 1 end rlhf_reward from rw"""
    adv = "update_id, prompt_id, rollout_id, rlhf_reward, advantage"
    sql["rloo_advantage"] = ro + f"select {adv} from adv"
    sql["rloo_advantage_any_k"] = ro + """select update_id, prompt_id, rollout_id, rlhf_reward,
        rlhf_reward - (sum(rlhf_reward) over g - rlhf_reward) / nullif(count(*) over g - 1, 0) advantage
        from rw window g as (partition by update_id, prompt_id)"""
    sql["rloo_advantage_paired"] = ro + """
        , pr as (select update_id, prompt_id, sample_idx, rollout_id,
                 case when has_eos then logit0 else logit0 - 1 end + non_score_reward rlhf_reward from rw)
        select update_id, prompt_id, rollout_id, rlhf_reward,
               rlhf_reward - (sum(rlhf_reward) over g - rlhf_reward) / nullif(count(*) over g - 1, 0) advantage
        from pr window g as (partition by update_id, prompt_id, sample_idx // 2)"""
    sql["importance_ratio"] = ro + """select rollout_id, ppo_epoch::bigint ppo_epoch,
        round(exp(new_logp_sum - logp_sum), 6) ratio,
        round(token_ratio_sum / n_tokens, 6) token_ratio_mean from rw join eg using (rollout_id)"""
    sql["ppo_clip_loss"] = ro + """select update_id,
        round(avg(case when loss1 > loss2 then loss1 else loss2 end), 6) policy_loss from pol group by 1"""
    sql["clip_fraction"] = ro + """select update_id, round(avg(case when loss2 > loss1 then 1.0::double
        when loss2 <= loss1 then 0.0::double end), 6) clipfrac from pol group by 1"""
    sql["approx_kl"] = ro + """select update_id, round(0.5 * avg(power(new_logp_sum - logp_sum, 2)), 6) approx_kl
        from rw join eg using (rollout_id) group by 1"""
    over_slots = """round(avg(approxkl), 6) "policy/approxkl_avg", round(avg(clipfrac), 6) "policy/clipfrac_avg",
        round(avg(policy_loss), 6) "loss/policy_avg", round(avg(entropy), 6) "policy/entropy_avg",
        round(avg(ratio), 6) "val/ratio", round(var_samp(ratio), 6) "val/ratio_var" """
    sql["slot_stats"] = ro + f"select update_id, {over_slots}, count(*) n_slots from slots group by 1"
    sql["update_metrics"] = ro + f"""
        , sm as (select update_id, {over_slots} from slots group by 1),
        ob as (select update_id, round(avg(kl), 6) "objective/kl", round(avg(-logp_sum), 6) "objective/entropy",
                      round(avg(non_score_reward), 6) "objective/non_score_reward",
                      round(avg(rlhf_reward), 6) "objective/rlhf_reward",
                      round(avg(reward_score), 6) "objective/scores",
                      cast(sum(num_eos) as bigint) "val/num_eos_tokens" from rw group by 1)
        select ob.*, sm.* exclude (update_id), 0.0::double "val/clipfrac_avg",
               round(1.0::double / (update_id * 4), 6) lr, update_id * 512 episode,
               cast(floor(update_id * 512 / (update_id * 30.0)) as bigint) eps,
               round(update_id * 512 / 2000.0::double, 6) epoch
        from ob join sm using (update_id)"""
    sql["objective_entropy"] = ro + """select update_id, round(avg(-logp_sum), 6) entropy,
        round(avg(-(logp_sum - n_masked)), 6) entropy_unmasked_only from rw group by 1"""
    report = _with(ROLLOUTS, COMPLETIONS) + """
        , resp as (select rollout_id, string_agg(truncated::varchar, ' ' order by i) response from tt group by 1)
        select rollout_id {key}, prompt as query, response "model response", reward_score score
        from rw join resp using (rollout_id) left join prompts on prompt_id = ordinal"""
    sql["completions_report"] = report.format(key="")
    sql["report_top"] = report.format(key="as ordinal").replace(
        "select rollout_id as ordinal", "select rw.rollout_id as ordinal"
    ) + " order by 1 limit 5"

    # judges
    sql["judge_prompt"] = _with(COMPLETIONS) + """
        select ordinal, 'Pick one.' || chr(10) || '[User Question]' || chr(10) || prompt || chr(10) || chr(10)
            || '[The Start of Assistant A''s Answer]' || chr(10) || answer_a || chr(10)
            || '[The End of Assistant A''s Answer]' || chr(10) || chr(10)
            || '[The Start of Assistant B''s Answer]' || chr(10) || answer_b || chr(10)
            || '[The End of Assistant B''s Answer]' judge_prompt from asked"""
    sql["cut_at_stop_string"] = _with(VERDICTS) + "select example_id, cut from cuts"
    sql["parse_verdict"] = _with(VERDICTS) + "select example_id, verdict_uncut, verdict from judged"
    sql["verdict_to_winner"] = _with(VERDICTS) + "select example_id, winner from judged"
    longer = """case when length(answer_a) > length(answer_b) then 0
        when length(answer_b) > length(answer_a) then 1 end"""
    sql["flip_order"] = _with(COMPLETIONS) + f"""
        , f as (select *, md5('3:' || ordinal || ':{_BASE}:{_SFT}')[1] < '8' flipped, {longer} winner from asked)
        select ordinal, flipped, case when flipped then answer_b else answer_a end answer_a,
               case when flipped then answer_a else answer_b end answer_b,
               case when flipped then 1 - winner else winner end shown_winner, winner from f"""
    sql["batch_generate"] = f"""select doc_id ordinal, trim('Echo: ' || text, {_STRIP}) text from documents"""
    sql["batch_judge"] = _with(COMPLETIONS) + f"""
        , j as (select ordinal, {JUDGED_TEXT} raw, {JUDGED_WINNER} winner from asked)
        select ordinal, raw, case when raw = 'cannot say' then 'error' when winner = 0 then 'A'
               when winner = 1 then 'B' else 'C' end verdict, winner from j"""
    sql["batch_score"] = """select doc_id, cast(length(source) % 9 as double) / 4 logit0,
        cast(length(text) % 7 as double) / 4 logit1 from documents join labels using (doc_id)"""
    sql["generate_completions"] = _with(COMPLETIONS) + f"""
        select ordinal, '{_KTO}' model, trim('Echo: ' || prompt, {_STRIP}) text
        from prompts"""
    sql["judge_against_reference"] = _with(COMPLETIONS) + f"""
        , j as (select model, {JUDGED_WINNER} winner from (select c.model, d.text answer_a, c.text answer_b
                from comp c join documents d on c.ordinal = d.doc_id))
        select model, count(winner) decided, coalesce(cast(sum(winner) as bigint), 0) wins,
               round(avg(winner), 6) win_rate, round(100 * avg(winner), 6) win_rate_percent from j group by 1"""
    sql["judge_matches"] = _with(COMPLETIONS) + f"""
        , j as (select model_a, model_b, {JUDGED_WINNER} winner from (
                select a.model model_a, b.model model_b, a.text answer_a, b.text answer_b
                from comp a join comp b on a.ordinal = b.ordinal and a.model < b.model
                join prompts p on p.ordinal = a.ordinal))
        select model_a, model_b, {rate} from j group by 1, 2"""

    # scalars
    sql["model_slug"] = """select c_custkey, replace(c_mktsegment || '/' || c_name, '/', '_') slug from customer"""
    sql["run_name"] = """select o_orderkey, replace('logs/rloo_unpaired-base_' || o_orderstatus || '-prefs_'
        || o_custkey || '-' || strftime(o_orderdate, '%Y%m%d_%H%M%S'), '_', '-') run_name from orders"""

    # streams
    sql["stream_unpaired"] = sql["pairs_to_unpaired"]
    sql["stream_thumbs_rate"] = """select cast(epoch(date_trunc('day', ts)) as bigint) window_start,
        count(*) filter (event_type = 'purchase') n_up, count(*) n,
        round(count(*) filter (event_type = 'purchase') / count(*), 6) up_rate
        from events where event_type in ('purchase', 'error') group by 1"""
    sql["stream_update_metrics"] = sql["update_metrics"].replace(
        "select ob.*,", "select ob.*, n_slots, n_rollouts, true complete,"
    ).replace(
        "from ob join sm using (update_id)",
        """from ob join sm using (update_id)
        join (select update_id, count(*) n_slots from slots group by 1) using (update_id)
        join (select update_id, count(*) n_rollouts from rw group by 1) using (update_id)""",
    )
    sql["stream_rloo_advantage"] = sql["rloo_advantage"]
    sql["stream_unpaired_repeated"] = sql["stream_unpaired"]
    sql["stream_thumbs_rate_repeated"] = sql["stream_thumbs_rate"]
    sql["slot_stats_bucketed"] = sql["slot_stats"]
    sql["update_metrics_bucketed"] = sql["update_metrics"]
    sql["batch_generate_resumed"] = sql["batch_generate"]
    sql["batch_judge_resumed"] = sql["batch_judge"]
    return sql
